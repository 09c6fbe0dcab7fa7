"""Table sinks: Bronze append, snapshot upsert and overwrite."""

from __future__ import annotations

import datetime as dt
import os

import pytest

from talentflow.plans.silver import transform
from talentflow.sources import tables

from .conftest import bronze_df


def _posting(job_id, title="Data Engineer"):
    return ("greenhouse", job_id, "acme", {"id": job_id, "title": title, "updated_at": "2026-01-14T10:55:28-05:00"}, f"https://x/{job_id}")


def batch(spark, items, day):
    return bronze_df(spark, [(*p, day) for p in items])


def test_append_counts_and_keeps_history(spark, tmp_dir):
    path = os.path.join(tmp_dir, "bronze")
    assert tables.append_bronze(batch(spark, [_posting("1"), _posting("2")], dt.date(2026, 8, 3)), path) == 2
    assert tables.append_bronze(batch(spark, [_posting("1")], dt.date(2026, 8, 4)), path) == 1
    df = tables.read_bronze(spark, path)
    assert df.count() == 3 and df.select("ingestion_date").distinct().count() == 2
    assert any(d.startswith("source=greenhouse") for d in os.listdir(path))
    assert df.filter("ingestion_date = DATE'2026-08-04'").count() == 1


def test_empty_append_creates_nothing(spark, tmp_dir):
    path = os.path.join(tmp_dir, "bronze")
    assert tables.append_bronze(batch(spark, [], dt.date(2026, 8, 4)), path) == 0
    assert not os.path.exists(path)


def test_transform_upserts_without_duplicates(spark, tmp_dir):
    b, s = os.path.join(tmp_dir, "bronze"), os.path.join(tmp_dir, "silver")
    tables.append_bronze(batch(spark, [_posting("1", "Data Engineer"), _posting("2")], dt.date(2026, 8, 3)), b)
    assert transform(spark, b, s) == 2
    tables.append_bronze(batch(spark, [_posting("1", "Senior Data Engineer")], dt.date(2026, 8, 4)), b)
    assert transform(spark, b, s) == 2
    silver = tables.read_silver(spark, s)
    got = {r["job_id"]: r["title"] for r in silver.collect()}
    assert got == {"greenhouse:1": "Senior Data Engineer", "greenhouse:2": "Data Engineer"}
    assert tables.versions(spark, s) == [0, 1]


def test_upsert_keeps_rows_missing_from_batch(spark, tmp_dir):
    s = os.path.join(tmp_dir, "snap")
    first = spark.createDataFrame([("a", 1), ("b", 2)], "job_id string, v int")
    second = spark.createDataFrame([("b", 20), ("c", 30)], "job_id string, v int")
    assert tables.upsert_snapshot(first, s) == 2
    assert tables.upsert_snapshot(second, s) == 2
    got = sorted(tuple(r) for r in tables.read_snapshot(spark, s).collect())
    assert got == [("a", 1), ("b", 20), ("c", 30)]
    assert tables.upsert_snapshot(second.limit(0), s) == 0 and tables.versions(spark, s) == [0, 1]
    assert os.listdir(os.path.join(s, "_batches")) == []


def test_interrupted_version_is_ignored(spark, tmp_dir):
    s = os.path.join(tmp_dir, "gold")
    assert tables.write_snapshot(spark.createDataFrame([(1,)], "x int"), s) == 1
    os.makedirs(os.path.join(s, "v=1"))  # a write that died before _SUCCESS
    assert [r["x"] for r in tables.read_snapshot(spark, s).collect()] == [1]
    assert tables.write_snapshot(spark.createDataFrame([(2,), (3,)], "x int"), s) == 2
    assert tables.versions(spark, s) == [0, 2]
    assert sorted(r["x"] for r in tables.read_snapshot(spark, s).collect()) == [2, 3]


def test_missing_table_reads_none(spark, tmp_dir):
    assert tables.read_snapshot(spark, os.path.join(tmp_dir, "none")) is None
    with pytest.raises(Exception):
        tables.read_bronze(spark, os.path.join(tmp_dir, "none")).count()


def test_incremental_transform_equals_full_recompute(spark, tmp_dir):
    def gh(job_id, title, updated):
        return ("greenhouse", job_id, "acme", {"id": job_id, "title": title, "updated_at": updated}, "u")

    d1, d2 = dt.date(2026, 8, 3), dt.date(2026, 8, 4)
    first = [gh("1", "a1", "2026-01-10T00:00:00Z"), gh("2", "b1", "2026-01-10T00:00:00Z"), gh("3", "c1", None)]
    second = [gh("1", "a2", "2026-01-10T00:00:00Z"),  # equal date: newer batch wins
              gh("2", "b2", "2026-01-05T00:00:00Z"),  # older publication: stored row stays
              gh("3", "c2", "2026-01-01T00:00:00Z"),  # stored row has no date: new one wins
              gh("4", "d2", None)]
    results = []
    for mode in ("full", "incremental"):
        b, s = os.path.join(tmp_dir, mode, "bronze"), os.path.join(tmp_dir, mode, "silver")
        tables.append_bronze(batch(spark, first, d1), b)
        transform(spark, b, s)
        tables.append_bronze(batch(spark, second, d2), b)
        transform(spark, b, s, since_date=d1 if mode == "incremental" else None)
        results.append({r["job_id"]: r["title"] for r in tables.read_silver(spark, s).collect()})
    assert results[0] == results[1] == {"greenhouse:1": "a2", "greenhouse:2": "b1", "greenhouse:3": "c2", "greenhouse:4": "d2"}


def test_staging_is_removed_and_vacuum_keeps_newest(spark, tmp_dir):
    s = os.path.join(tmp_dir, "snap")
    for i in range(4):
        tables.upsert_snapshot(spark.createDataFrame([(f"k{i}", i)], "job_id string, v int"), s)
    assert tables.versions(spark, s) == [0, 1, 2, 3]
    assert os.listdir(os.path.join(s, "_batches")) == []  # each run removed its staging copy
    os.makedirs(os.path.join(s, "v=4"))  # an interrupted write
    os.makedirs(os.path.join(s, "_batches", "b=9"))  # a job in flight
    assert tables.vacuum(spark, s, keep=2) == ["v=0", "v=1"]
    assert tables.vacuum(spark, s, keep=2, staging_hours=0) == ["_batches/b=9"]
    assert tables.versions(spark, s) == [2, 3] and os.path.isdir(os.path.join(s, "v=4"))
    assert sorted(r["job_id"] for r in tables.read_snapshot(spark, s).collect()) == ["k0", "k1", "k2", "k3"]
    fresh = os.path.join(tmp_dir, "fresh")
    os.makedirs(os.path.join(fresh, "v=0"))  # a first write still in flight
    assert tables.vacuum(spark, fresh) == [] and os.path.isdir(os.path.join(fresh, "v=0"))
