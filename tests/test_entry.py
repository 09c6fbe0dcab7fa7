"""Driver contract: entry() runs, every query of the library has an oracle,
every registered query runs on the smoke data."""

from __future__ import annotations

import pytest

import __spark_entry__ as E
from talentflow.plans.queries import ORACLES, QUERIES

SMOKE = "/root/testdata/sf0.001"


def test_entry_runs_on_smoke_data(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns[:3] == ["profile_id", "job_id", "company"]
    assert {r["profile_id"] for r in rows} == {"data-engineer", "platform", "junior"}


def test_every_query_of_the_library_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(E.queries()) and set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_runs_on_smoke_data(spark, name):
    df = E.queries()[name](spark, SMOKE)
    assert df.columns
    df.limit(1).collect()
