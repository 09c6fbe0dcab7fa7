from __future__ import annotations

import datetime as dt
import json
import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from talentflow.schemas import BRONZE  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[*]")
        .appName("talentflow-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    from talentflow.session import ensure_checkpoint_dir

    ensure_checkpoint_dir(session)
    yield session


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="talentflow-test-")


FETCHED = dt.datetime(2026, 8, 4, 9, 0, 0)


def bronze_df(spark, rows):
    """rows: (source, source_job_id, company, payload dict or raw str, url, ingestion_date[, fetched_at])."""
    out = []
    for r in rows:
        source, sid, company, payload, url, day = r[:6]
        fetched = r[6] if len(r) > 6 else FETCHED
        text = payload if isinstance(payload, str) else json.dumps(payload, ensure_ascii=False)
        out.append((source, sid, company, fetched, url, text, day))
    return spark.createDataFrame(out, BRONZE)


def one_col(spark, values, ddl="t string"):
    return spark.createDataFrame([(v,) for v in values], ddl)
