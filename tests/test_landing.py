"""Landed responses -> Bronze rows."""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import functions as F

from talentflow.sources import landing

FETCHED = dt.datetime(2026, 8, 4, 9, 0, 0)


def responses(spark, rows):
    """rows: (source, company, body dict or raw text)."""
    data = [(s, c, FETCHED, b if isinstance(b, str) else json.dumps(b)) for s, c, b in rows]
    return spark.createDataFrame(data, "source string, company_identifier string, fetched_at timestamp, body string")


def test_board_a_response(spark):
    body = {"jobs": [{"id": 12345, "title": "Senior Data Engineer", "absolute_url": "https://boards.example.com/acme/jobs/12345"}]}
    rows, rejects = landing.explode_responses(responses(spark, [("greenhouse", "acme", body)]))
    r = rows.collect()
    assert len(r) == 1 and rejects.count() == 0
    assert (r[0]["source"], r[0]["source_job_id"], r[0]["company_identifier"], r[0]["url"]) == (
        "greenhouse", "12345", "acme", "https://boards.example.com/acme/jobs/12345")
    assert json.loads(r[0]["raw_payload"])["title"] == "Senior Data Engineer"


def test_board_b_content_then_postings_fallback(spark):
    r1 = {"content": [{"id": "98765", "name": "Lead", "applyUrl": "https://jobs.example.com/98765"}]}
    r2 = {"postings": [{"id": "1", "jobAdUrl": "https://ads.example.com/1"}, {"id": "2"}]}
    r3 = {"content": [], "postings": [{"id": "3"}]}
    rows, _ = landing.explode_responses(responses(spark, [("smartrecruiters", "acme", r1), ("smartrecruiters", "b", r2), ("smartrecruiters", "c", r3)]))
    got = sorted((r["source_job_id"], r["url"]) for r in rows.collect())
    assert got == [("1", "https://ads.example.com/1"), ("2", ""), ("98765", "https://jobs.example.com/98765")]


def test_payload_text_is_kept_verbatim(spark):
    raw = '{"jobs": [{"title": "Ingegnere è", "id": 7, "salary": 1.0, "b": 1e3}]}'
    rows, _ = landing.explode_responses(responses(spark, [("greenhouse", "acme", raw)]))
    payload = rows.first()["raw_payload"]
    assert payload.startswith('{"title":"Ingegnere è","id":7,"salary":1.0')
    assert json.loads(payload)["title"] == "Ingegnere è"


def test_response_rejects(spark):
    rows, rejects = landing.explode_responses(
        responses(
            spark,
            [
                ("greenhouse", "a", {"jobs": None}),
                ("greenhouse", "b", "not json"),
                ("workday", "c", {"jobs": []}),
                ("greenhouse", "d", {"jobs": [{"title": "no id"}]}),
                ("greenhouse", "e", {"other": 1}),
            ],
        )
    )
    assert rows.count() == 0
    got = sorted((r["company_identifier"], r["reject_reason"]) for r in rejects.collect())
    assert got == [("a", "null_postings_list"), ("b", "malformed_json"), ("c", "unknown_source"), ("d", "posting_without_id")]


def test_target_gate_and_bronze_rows(spark):
    resp = responses(spark, [("greenhouse", "stripe", {"jobs": [{"id": 1}]}), ("greenhouse", "linkedin", {"jobs": [{"id": 2}]})])
    targets = landing.targets_frame(spark, [("greenhouse", "stripe", "none"), ("greenhouse", "linkedin", "excluded")])
    rows, _ = landing.explode_responses(landing.gate_targets(resp, targets, broadcast_ok=True))
    bronze = landing.to_bronze(rows, dt.date(2026, 8, 4))
    got = bronze.collect()
    assert [r["company_identifier"] for r in got] == ["stripe"]
    assert bronze.columns == ["source", "source_job_id", "company_identifier", "fetched_at", "url", "raw_payload", "ingestion_date"]
    assert got[0]["ingestion_date"] == dt.date(2026, 8, 4)


def test_read_landed_files(spark, tmp_dir):
    import os

    for company in ("acme", "007"):
        d = os.path.join(tmp_dir, "source=greenhouse", f"company_identifier={company}")
        os.makedirs(d)
        with open(os.path.join(d, "page-1.json"), "w") as f:
            f.write(json.dumps({"jobs": [{"id": 1}, {"id": 2}]}, indent=2))
    rows, _ = landing.explode_responses(landing.read_landed(spark, tmp_dir))
    got = sorted((r["company_identifier"], r["source_job_id"]) for r in rows.collect())
    assert got == [("007", "1"), ("007", "2"), ("acme", "1"), ("acme", "2")]


def test_json_is_read_as_python_reads_it(spark):
    page = '{"jobs": [{"id": 1, "id": 2}, {"id": true}, {"id": 1.0}, {"id": null}, "text", {"id": "x", "absolute_url": "u"}], "z": 1}'
    rows, rejects = landing.explode_responses(responses(spark, [("greenhouse", "Fjord", page)]))
    assert sorted((r["source_job_id"], r["url"]) for r in rows.collect()) == [("1.0", ""), ("2", ""), ("None", ""), ("True", ""), ("x", "u")]
    assert [r["reject_reason"] for r in rejects.collect()] == ["posting_without_id"]
    later = '{"jobs": [{"id": 1}], "jobs": [{"id": 7}]}'
    broken = '{"jobs": [{"id": 1}]} and more'
    rows, rejects = landing.explode_responses(
        responses(spark, [("greenhouse", "a", later), ("greenhouse", "b", broken), ("greenhouse", "c", "[]")])
    )
    assert [r["source_job_id"] for r in rows.collect()] == ["7"]
    assert sorted((r["company_identifier"], r["reject_reason"]) for r in rejects.collect()) == [
        ("b", "malformed_json"), ("c", "response_not_object")]


def test_a_page_of_twenty_megabytes(spark):
    line = "w" * 100
    df = responses(spark, [("greenhouse", "Fjord", "%s")]).withColumn(
        "body", F.concat(F.lit('{"jobs": [{"id": 1}, {"id": 2, "content": "'), F.repeat(F.lit(line), 205_000), F.lit('"}]}'))
    )
    got = landing.explode_all(df).selectExpr("source_job_id", "length(raw_payload) n", "reject_reason").collect()
    assert [(r["source_job_id"], r["n"] > 20_500_000, r["reject_reason"]) for r in got] == [("1", False, None), ("2", True, None)]
