"""Landing -> Bronze as a stream: incremental, gated, retry-safe layout."""

from __future__ import annotations

import datetime as dt
import json
import os

from talentflow.sources import landing, tables
from talentflow.streaming import start_landing_stream


def land(root, source, company, name, body):
    d = os.path.join(root, f"source={source}", f"company_identifier={company}")
    os.makedirs(d, exist_ok=True)
    with open(os.path.join(d, name), "w") as f:
        f.write(json.dumps(body))


def test_stream_is_incremental_and_gated(spark, tmp_dir):
    root, bronze, rejects, ckpt = (os.path.join(tmp_dir, x) for x in ("landing", "bronze", "rejects", "ckpt"))
    targets = landing.targets_frame(spark, [("greenhouse", "acme", "none"), ("greenhouse", "linkedin", "excluded"),
                                            ("smartrecruiters", "bosch", "low")])
    land(root, "greenhouse", "acme", "p1.json", {"jobs": [{"id": 1}, {"id": 2}]})
    land(root, "greenhouse", "linkedin", "p1.json", {"jobs": [{"id": 9}]})
    land(root, "smartrecruiters", "bosch", "p1.json", {"content": None})
    day = dt.date(2026, 8, 4)
    q = start_landing_stream(spark, root, bronze, rejects, ckpt, targets=targets, ingestion_date=day)
    q.awaitTermination(120)
    df = tables.read_bronze(spark, bronze)
    assert sorted(r["source_job_id"] for r in df.collect()) == ["1", "2"]
    assert [r["reject_reason"] for r in spark.read.parquet(rejects).collect()] == ["null_postings_list"]

    land(root, "greenhouse", "acme", "p2.json", {"jobs": [{"id": 3}]})
    q = start_landing_stream(spark, root, bronze, rejects, ckpt, targets=targets, ingestion_date=day)
    q.awaitTermination(120)
    df = tables.read_bronze(spark, bronze)
    assert sorted(r["source_job_id"] for r in df.collect()) == ["1", "2", "3"]
    assert df.filter("ingestion_date = DATE'2026-08-04'").count() == 3


def test_replayed_batch_does_not_duplicate(spark, tmp_dir):
    from talentflow.streaming.landing_stream import _batch_writer

    bronze, rejects = os.path.join(tmp_dir, "bronze"), os.path.join(tmp_dir, "rejects")
    batch = spark.createDataFrame(
        [("greenhouse", "acme", dt.datetime(2026, 8, 4, 9), json.dumps({"jobs": [{"id": 1}, {"id": 2}]}))],
        "source string, company_identifier string, fetched_at timestamp, body string",
    )
    write = _batch_writer(bronze, rejects, dt.date(2026, 8, 4))
    write(batch, 7)
    write(batch, 7)  # the same epoch again, as after a failure
    write(batch.limit(0), 8)
    assert tables.read_bronze(spark, bronze).count() == 2


def test_batch_and_stream_share_one_layout(spark, tmp_dir):
    from talentflow.plans import jobs

    root, other, bronze, rejects, ckpt = (os.path.join(tmp_dir, x) for x in ("landing", "other", "bronze", "rejects", "ckpt"))
    land(root, "greenhouse", "Fjord", "s.json", {"jobs": [{"id": 1}]})
    land(other, "greenhouse", "Fjord", "b.json", {"jobs": [{"id": 2}, {"id": 3}]})
    day = dt.date(2025, 6, 1)
    start_landing_stream(spark, root, bronze, rejects, ckpt, ingestion_date=day).awaitTermination(120)
    assert jobs.land_to_bronze(spark, other, bronze, rejects, ingestion_date=day) == 2
    assert sorted(r["source_job_id"] for r in tables.read_bronze(spark, bronze).collect()) == ["1", "2", "3"]


def test_a_batch_retried_after_midnight_keeps_its_date(spark, tmp_dir):
    from talentflow.streaming.landing_stream import _batch_writer

    bronze, rejects = os.path.join(tmp_dir, "bronze"), os.path.join(tmp_dir, "rejects")
    batch = spark.createDataFrame(
        [("greenhouse", "Fjord", dt.datetime(2025, 6, 1, 23, 59), json.dumps({"jobs": [{"id": 5}]}))],
        "source string, company_identifier string, fetched_at timestamp, body string",
    )
    for day in (dt.date(2025, 6, 1), dt.date(2025, 6, 2)):
        _batch_writer(bronze, rejects, day)(batch, 3)
    assert [r["ingestion_date"] for r in tables.read_bronze(spark, bronze).collect()] == [dt.date(2025, 6, 1)]
