"""Path-level jobs end to end: landing -> Bronze -> Silver -> Gold, matching."""

from __future__ import annotations

import datetime as dt
import json
import os

from talentflow.plans import jobs
from talentflow.sources import tables


def land(root, source, company, name, body):
    d = os.path.join(root, f"source={source}", f"company_identifier={company}")
    os.makedirs(d, exist_ok=True)
    with open(os.path.join(d, name), "w") as f:
        f.write(json.dumps(body))


def gh(i, title, content):
    return {"id": i, "title": title, "updated_at": "2026-01-14T10:55:28-05:00", "content": content,
            "absolute_url": f"https://boards.example.com/{i}"}


def test_jobs_end_to_end(spark, tmp_dir):
    p = {k: os.path.join(tmp_dir, k) for k in ("landing", "landing2", "bronze", "rej", "silver", "gold")}
    land(p["landing"], "greenhouse", "acme", "a.json", {"jobs": [
        gh(1, "Data Engineer", "<p>Azure Databricks, Apache Spark. 3+ years</p>"),
        gh(2, "Data   engineer", "<p>Kafka and Kubernetes. 10+ years</p>")]})
    d1, d2 = dt.date(2026, 8, 3), dt.date(2026, 8, 4)
    assert jobs.land_to_bronze(spark, p["landing"], p["bronze"], p["rej"], ingestion_date=d1) == 2
    assert jobs.bronze_to_silver(spark, p["bronze"], p["silver"]) == 2
    land(p["landing2"], "greenhouse", "acme", "b.json", {"jobs": [gh(1, "Data Engineer", "<p>Azure Databricks, Apache Spark. 3+ years</p>")]})
    jobs.land_to_bronze(spark, p["landing2"], p["bronze"], p["rej"], ingestion_date=d2)
    assert jobs.bronze_to_silver(spark, p["bronze"], p["silver"], since_date=d2) == 1
    counts = jobs.write_gold(spark, p["gold"], p["silver"], p["bronze"], d1, d2)
    assert counts == {"active_companies": 1, "tech_trends": 5, "duplicate_postings": 2, "new_postings": 0, "removed_postings": 1}
    removed = tables.read_snapshot(spark, os.path.join(p["gold"], "removed_postings")).collect()
    assert [r["job_id"] for r in removed] == ["greenhouse:2"]
    ranked = jobs.match_cv(spark, p["silver"], "Azure Databricks and Apache Spark engineer", 5.0).collect()
    assert [r["job_id"] for r in ranked] == ["greenhouse:1", "greenhouse:2"] and ranked[0]["match_score"] == 100


def board(*ids):
    return {"jobs": [{"id": i, "title": f"Post {i}"} for i in ids]}


def test_runs_take_only_new_files(spark, tmp_dir):
    landing, bronze, rej = (os.path.join(tmp_dir, k) for k in ("landing", "bronze", "rej"))
    d1, d2 = dt.date(2025, 5, 1), dt.date(2025, 5, 2)
    land(landing, "greenhouse", "Fjord", "one.json", board(1, 2))
    land(landing, "greenhouse", "Fjord", "bad.json", {"jobs": None})
    assert jobs.land_to_bronze(spark, landing, bronze, rej, ingestion_date=d1, run_id="a") == 2
    land(landing, "greenhouse", "Fjord", "two.json", board(2, 3))
    assert jobs.land_to_bronze(spark, landing, bronze, rej, ingestion_date=d2, run_id="b") == 2
    assert jobs.land_to_bronze(spark, landing, bronze, rej, ingestion_date=d2, run_id="c") == 0
    stored = tables.read_bronze(spark, bronze)
    assert sorted((r["source_job_id"], r["ingestion_date"]) for r in stored.collect()) == [("1", d1), ("2", d1), ("2", d2), ("3", d2)]
    assert [r["reject_reason"] for r in spark.read.parquet(rej).collect()] == ["null_postings_list"]
    from talentflow.operators import views

    assert [r["job_id"] for r in views.removed_postings(stored, d1, d2).collect()] == ["greenhouse:1"]


def test_a_repeated_run_replaces_itself(spark, tmp_dir):
    landing, bronze, rej = (os.path.join(tmp_dir, k) for k in ("landing", "bronze", "rej"))
    land(landing, "greenhouse", "Fjord", "one.json", {"jobs": [{"id": 1}, {"title": "no id"}]})
    day = dt.date(2025, 5, 1)
    for later in (0, 1):  # the second try is after midnight
        assert jobs.land_to_bronze(spark, landing, bronze, rej, ingestion_date=day + dt.timedelta(later), run_id="r") == 1
    assert [r["ingestion_date"] for r in tables.read_bronze(spark, bronze).collect()] == [day]
    assert [r["reject_reason"] for r in spark.read.parquet(rej).collect()] == ["posting_without_id"]


def test_silver_rejects_are_kept_once(spark, tmp_dir):
    landing, bronze, rej, silver, bad = (os.path.join(tmp_dir, k) for k in ("landing", "bronze", "rej", "silver", "bad"))
    land(landing, "greenhouse", "Fjord", "one.json", {"jobs": [{"id": 1, "title": "ok"}, {"id": 2, "title": None}]})
    jobs.land_to_bronze(spark, landing, bronze, rej, ingestion_date=dt.date(2025, 5, 1))
    for _ in range(3):
        assert jobs.bronze_to_silver(spark, bronze, silver, rejects_path=bad) == 1
    assert [r["job_id"] for r in spark.read.parquet(bad).collect()] == ["greenhouse:2"]


def test_silver_continues_from_the_recorded_date(spark, tmp_dir):
    landing, bronze, rej, silver = (os.path.join(tmp_dir, k) for k in ("landing", "bronze", "rej", "silver"))
    d1, d2 = dt.date(2025, 5, 1), dt.date(2025, 5, 2)
    land(landing, "greenhouse", "Fjord", "one.json", board(1, 2))
    jobs.land_to_bronze(spark, landing, bronze, rej, ingestion_date=d1)
    assert jobs.bronze_to_silver(spark, bronze, silver) == 2 and tables.high_water(spark, silver) == d1
    land(landing, "greenhouse", "Fjord", "late.json", board(3))  # more of the same day
    jobs.land_to_bronze(spark, landing, bronze, rej, ingestion_date=d1)
    assert jobs.bronze_to_silver(spark, bronze, silver) == 3
    land(landing, "greenhouse", "Fjord", "two.json", board(4))
    jobs.land_to_bronze(spark, landing, bronze, rej, ingestion_date=d2)
    assert jobs.bronze_to_silver(spark, bronze, silver) == 4  # day one again, which changes nothing
    assert jobs.bronze_to_silver(spark, bronze, silver) == 1 and tables.high_water(spark, silver) == d2
    kept = sorted(r["job_id"] for r in tables.read_silver(spark, silver).collect())
    assert kept == [f"greenhouse:{i}" for i in (1, 2, 3, 4)]
    assert jobs.bronze_to_silver(spark, bronze, silver, full=True) == 4
