"""Presence intervals against plain sets; removals with evidence of a fetch."""

from __future__ import annotations

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from talentflow.operators import presence, views
from talentflow.plans import jobs
from talentflow.sources import landing, tables
from tests.conftest import bronze_df
from tests.test_jobs import board, land

D = [dt.date(2026, 8, d) for d in (1, 2, 4, 7, 8, 9)]


def rows_of(held):
    """held: day -> ids; every row twice, as two fetches of one day give it."""
    return [("greenhouse", i, "c", "{}", "", day) for day, ids in held.items() for i in ids for _ in range(2)]


def as_id(i):
    return f"greenhouse:{i}"


@pytest.mark.parametrize("seed", range(2))
def test_intervals_equal_plain_sets(spark, seed):
    rng = random.Random(seed)
    held = {day: {str(i) for i in range(12) if rng.random() < 0.6} | {"always"} for day in D}
    bronze = bronze_df(spark, rows_of(held))
    undated = bronze.limit(1).withColumns({"source_job_id": F.lit("undated"), "ingestion_date": F.lit(None).cast("date")})
    bronze = bronze.unionByName(undated).cache()
    intervals = presence.presence_intervals(bronze).cache()
    want = set()
    for i in set().union(*held.values()):
        runs, inside = [], False
        for k, day in enumerate(D):
            if i in held[day]:
                runs = runs if inside else runs + [[day, day, None]]
                runs[-1][1:] = [day, D[k + 1] if k + 1 < len(D) else None]
            inside = i in held[day]
        want |= {(as_id(i), no + 1, *run) for no, run in enumerate(runs)}
    assert sorted(map(tuple, intervals.collect()), key=str) == sorted(want, key=str)
    for day in D[:3]:
        assert {r.job_id for r in presence.open_on(intervals, day).collect()} == set(map(as_id, held[day]))
    for day, other in ((D[0], D[1]), (D[1], D[4]), (D[0], D[5])):
        got = {(r.job_id, r.change) for r in presence.changes_between(intervals, day, other).collect()}
        new = {r.job_id for r in views.new_postings(bronze, day, other).collect()}
        removed = {r.job_id for r in views.removed_postings(bronze, day, other).collect()}
        assert got == {(j, "new") for j in new} | {(j, "removed") for j in removed}
    # a day without a batch has the state of the batch before it
    assert {r.job_id for r in presence.open_on(intervals, dt.date(2026, 8, 5)).collect()} == set(map(as_id, held[D[2]]))
    assert presence.open_on(intervals, dt.date(2026, 7, 1)).count() == 0
    for r in presence.activity_by_day(intervals).collect():
        k = D.index(r.day)
        before = held[D[k - 1]] if k else set()
        seen = set().union(*[held[d] for d in D[:k]])
        come = held[r.day] - before
        assert (r.new_count, r.returned_count) == (len(come - seen), len(come & seen))
        assert (r.removed_count, r.open_count) == (len(before - held[r.day]), len(held[r.day]))
    intervals.unpersist()
    bronze.unpersist()


def test_an_empty_history_has_no_intervals(spark):
    intervals = presence.presence_intervals(bronze_df(spark, []))
    assert intervals.count() == 0 and presence.activity_by_day(intervals).count() == 0


def test_intervals_shuffle_the_rows_once(spark):
    bronze = bronze_df(spark, rows_of({D[0]: {"1"}}))
    plan = presence.presence_intervals(bronze)._jdf.queryExecution().executedPlan().toString()
    initial = plan.split("Initial Plan")[-1]
    # the keys' aggregate, and two of the calendar: its distinct dates and their order
    assert initial.count("Exchange hashpartitioning(job_id") <= 1
    assert "SortMergeJoin" not in initial


def test_removals_need_a_complete_fetch(spark):
    before = [("greenhouse", i, c, "{}", "", D[0]) for c, i in (
        ("full", "1"), ("full", "2"), ("empty", "3"), ("failed", "4"), ("missing", "5"), ("partly", "6"), ("null", "7"),
        ("full", "8"), ("missing", "8"), ("full", "9"))]
    now = [("greenhouse", "1", "full", "{}", "", D[1]), ("greenhouse", "9", "partly", "{}", "", D[1])]
    responses = spark.createDataFrame(
        [("greenhouse", c, dt.datetime(2026, 8, 2), body) for c, body in (
            ("full", '{"jobs": [{"id": 1}, {"title": "no id"}]}'), ("empty", '{"jobs": []}'), ("failed", "<html>"),
            ("partly", '{"jobs": []}'), ("partly", '{"jobs": null}'))],
        "source string, company_identifier string, fetched_at timestamp, body string")
    fetches = landing.fetch_outcomes(landing.explode_all(responses, keep_empty=True), D[1])
    assert sorted((r.company_identifier, r.failed_responses, r.postings, r.complete) for r in fetches.collect()) == [
        ("empty", 0, 0, True), ("failed", 1, 0, False), ("full", 0, 1, True), ("partly", 1, 0, False)]
    bronze = bronze_df(spark, before + now).withColumn("company_identifier", F.expr("nullif(company_identifier, 'null')"))
    got = presence.removed_with_evidence(bronze, fetches, D[0], D[1])
    # 8 may still be with the target that was not fetched; 9 moved to another target
    assert sorted(r.job_id for r in got.collect()) == ["greenhouse:2", "greenhouse:3"]
    assert presence.removed_with_evidence(bronze, fetches.limit(0), D[0], D[1]).count() == 0


def test_landing_job_keeps_what_was_fetched(spark, tmp_dir):
    root, bronze, rejects, silver, gold = (os.path.join(tmp_dir, k) for k in ("landing", "bronze", "rejects", "silver", "gold"))
    for company, ids in (("acme", (1, 2)), ("idle", (3,)), ("down", (4,)), ("gone", (5,))):
        land(root, "greenhouse", company, "1.json", board(*ids))
    assert jobs.land_to_bronze(spark, root, bronze, rejects, ingestion_date=D[0]) == 5
    land(root, "greenhouse", "acme", "2.json", board(1))
    land(root, "greenhouse", "idle", "2.json", board())
    land(root, "greenhouse", "down", "2.json", [])
    for _ in range(2):  # a run that is repeated replaces its own outcome
        assert jobs.land_to_bronze(spark, root, bronze, rejects, ingestion_date=D[1], run_id="second") == 1
    fetches = tables.read_fetches(spark, bronze).filter(f"ingestion_date = '{D[1]}'")
    assert sorted((r.company_identifier, r.postings, r.complete) for r in fetches.collect()) == [
        ("acme", 1, True), ("down", 0, False), ("idle", 0, True)]
    assert [r.reject_reason for r in spark.read.parquet(rejects).collect()] == ["response_not_object"]
    assert tables.read_bronze(spark, bronze).count() == 6
    jobs.bronze_to_silver(spark, bronze, silver)
    names = ("removed_postings", "posting_intervals")
    assert jobs.write_gold(spark, gold, silver, bronze, D[0], D[1], fetch_evidence=True, names=names) == {"removed_postings": 2, "posting_intervals": 5}
    removed = tables.read_snapshot(spark, os.path.join(gold, "removed_postings"))
    assert sorted(r.job_id for r in removed.collect()) == ["greenhouse:2", "greenhouse:3"]
    assert tables.read_fetches(spark, os.path.join(tmp_dir, "nowhere")).count() == 0
