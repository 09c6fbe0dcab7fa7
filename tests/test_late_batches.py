"""Batches that arrive late or again, and landed files rewritten in place."""

from __future__ import annotations

import datetime as dt
import os
from urllib.parse import unquote

from pyspark.sql import functions as F

from talentflow.plans import jobs
from talentflow.plans import silver as silver_plan
from talentflow.schemas import SILVER_COLUMNS
from talentflow.sources import landing, tables
from tests.test_jobs import board, land

D1, D2, D3 = (dt.date(2025, 5, d) for d in (1, 2, 3))


def titles(spark, silver):
    return {r["job_id"].split(":")[1]: r["title"] for r in tables.read_silver(spark, silver).collect()}


def test_silver_takes_in_older_dates_and_replaced_batches(spark, tmp_dir):
    l2, l1, l3, bronze, rej, silver = (os.path.join(tmp_dir, k) for k in ("l2", "l1", "l3", "bronze", "rej", "silver"))
    land(l2, "greenhouse", "Fjord", "two.json", {"jobs": [{"id": 1, "title": "new"}]})
    jobs.land_to_bronze(spark, l2, bronze, rej, ingestion_date=D2, run_id="b")
    assert jobs.bronze_to_silver(spark, bronze, silver) == 1
    # a backfill under an older date: its new posting comes in, its old state of posting 1 does not win
    land(l1, "greenhouse", "Fjord", "one.json", {"jobs": [{"id": 1, "title": "old"}, {"id": 2, "title": "late"}]})
    jobs.land_to_bronze(spark, l1, bronze, rej, ingestion_date=D1, run_id="a")
    jobs.bronze_to_silver(spark, bronze, silver)
    assert titles(spark, silver) == {"1": "new", "2": "late"}
    land(l3, "greenhouse", "Fjord", "three.json", board(3))
    jobs.land_to_bronze(spark, l3, bronze, rej, ingestion_date=D3, run_id="c")
    assert jobs.bronze_to_silver(spark, bronze, silver) == 2  # from the recorded date on: nothing older is open
    # a run written again under the date of its first try, after newer dates were merged
    land(l1, "greenhouse", "Fjord", "more.json", {"jobs": [{"id": 4, "title": "again"}]})
    jobs.land_to_bronze(spark, l1, bronze, rej, ingestion_date=D3, run_id="a")
    jobs.bronze_to_silver(spark, bronze, silver)
    got = titles(spark, silver)
    assert got == {"1": "new", "2": "late", "3": "Post 3", "4": "again"}
    fresh = os.path.join(tmp_dir, "fresh")
    jobs.bronze_to_silver(spark, bronze, fresh, full=True)
    assert titles(spark, fresh) == got
    assert jobs.bronze_to_silver(spark, bronze, silver) == 1  # all files are recorded


def test_a_file_rewritten_in_place_is_read_again(spark, tmp_dir):
    landing, bronze, rej = (os.path.join(tmp_dir, k) for k in ("landing", "bronze", "rej"))
    land(landing, "greenhouse", "Fjord", "one.json", board(1))
    land(landing, "greenhouse", "Fjord", "same.json", board(9))
    assert jobs.land_to_bronze(spark, landing, bronze, rej, ingestion_date=D1) == 2
    land(landing, "greenhouse", "Fjord", "one.json", board(1, 2))
    path = os.path.join(landing, "source=greenhouse", "company_identifier=Fjord", "one.json")
    later = os.path.getmtime(path) + 5
    os.utime(path, (later, later))
    assert jobs.land_to_bronze(spark, landing, bronze, rej, ingestion_date=D2) == 2
    assert jobs.land_to_bronze(spark, landing, bronze, rej, ingestion_date=D2) == 0


def test_a_late_batch_reads_its_own_date_alone(spark, tmp_dir, monkeypatch):
    bronze, silver, fresh, rej = (os.path.join(tmp_dir, k) for k in ("bronze", "silver", "fresh", "rej"))

    def batch(day, run, **posts):
        root = os.path.join(tmp_dir, f"landing-{run}")
        land(root, "greenhouse", "Fjord", "a.json", {"jobs": [{"id": int(i[1:]), "title": t} for i, t in posts.items()]})
        jobs.land_to_bronze(spark, root, bronze, rej, ingestion_date=day, run_id=run)

    for n in range(2, 9):
        batch(dt.date(2025, 5, n), f"r{n}", p1=f"day {n}", **{f"p{n}": f"only {n}"})
        jobs.bronze_to_silver(spark, bronze, silver)
    read = []
    mapped = silver_plan.normalize
    monkeypatch.setattr(silver_plan, "normalize", lambda df: read.append(sorted({f.split("ingestion_date=")[1][:10] for f in files_of(df)})) or mapped(df))
    batch(dt.date(2024, 5, 1), "late", p1="a year old", p3="older than day 3", p99="late only")
    jobs.bronze_to_silver(spark, bronze, silver)
    batch(dt.date(2025, 5, 4), "more of day 4", p4="day 4 again", p1="still day 4")
    jobs.bronze_to_silver(spark, bronze, silver)
    assert read == [["2024-05-01", "2025-05-08"], ["2025-05-04", "2025-05-08"]]
    assert tables.open_days(spark, silver, tables.bronze_parts(spark, bronze), dt.date(2025, 5, 8)) == []
    got = titles(spark, silver)
    assert (got["1"], got["3"], got["99"]) == ("day 8", "only 3", "late only")
    jobs.bronze_to_silver(spark, bronze, fresh, full=True)
    assert titles(spark, fresh) == got
    assert tables.read_silver(spark, silver).columns == tables.read_silver(spark, fresh).columns == SILVER_COLUMNS


def files_of(df):
    return [r[0] for r in df.select(F.input_file_name()).distinct().collect()]


def test_a_run_reads_the_content_of_new_files_only(spark, tmp_dir, monkeypatch):
    landing_root, bronze, rej = (os.path.join(tmp_dir, k) for k in ("landing", "bronze", "rej"))
    scans = []
    read = landing.read_landed
    monkeypatch.setattr(landing, "read_landed", lambda *a: scans.append(read(*a)) or scans[-1])
    names = ["one 1.json", "two[2].json", "three%20.json", "sp*.json"]
    for n, name in enumerate(names):
        land(landing_root, "greenhouse", "Fjord", name, board(n))
        assert jobs.land_to_bronze(spark, landing_root, bronze, rej, ingestion_date=D1, run_id=f"r{n}") == 1
        assert [os.path.basename(unquote(f)) for f in scans[-1].inputFiles()] == [name]
    assert jobs.land_to_bronze(spark, landing_root, bronze, rej, ingestion_date=D1, run_id="none") == 0
    assert sorted(r.source_job_id for r in tables.read_bronze(spark, bronze).collect()) == ["0", "1", "2", "3"]


def test_rows_stored_without_order_count_as_older(spark, tmp_dir):
    landing_root, bronze, rej, silver = (os.path.join(tmp_dir, k) for k in ("landing", "bronze", "rej", "silver"))
    land(landing_root, "greenhouse", "Fjord", "a.json", {"jobs": [{"id": 1, "title": "new"}]})
    jobs.land_to_bronze(spark, landing_root, bronze, rej, ingestion_date=D2)
    jobs.bronze_to_silver(spark, bronze, silver)
    plain = tables.read_silver(spark, silver).withColumn("title", F.lit("stored by an earlier version"))
    tables.write_snapshot(plain, silver)
    assert jobs.bronze_to_silver(spark, bronze, silver) == 1
    assert titles(spark, silver) == {"1": "new"}
