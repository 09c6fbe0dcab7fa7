"""Bronze -> Silver mapping (N1-N3, N10) and the Silver job."""

from __future__ import annotations

import datetime as dt
import json

import pytest

from talentflow.operators.normalize import normalize, split_rejects
from talentflow.plans.silver import silver_batch
from talentflow.schemas import SILVER_COLUMNS

from .conftest import bronze_df

MON, TUE, WED = dt.date(2025, 3, 3), dt.date(2025, 3, 4), dt.date(2025, 3, 5)
A, B = "greenhouse", "smartrecruiters"


def board_a(number, **changes):
    p = {"id": number, "title": f"Role {number}", "location": {"name": "Oslo"}, "updated_at": "2025-02-20T08:00:00+01:00"}
    return {k: v for k, v in (p | changes).items() if v is not ...}


def board_b(number, text=None, **changes):
    ad = {"sections": {"jobDescription": {"text": text}}} if text is not None else {}
    p = {"id": f"{number}", "name": f"Post {number}", "releasedDate": "2025-02-21T09:30:00Z", "jobAd": ad}
    return {k: v for k, v in (p | changes).items() if v is not ...}


def rows_of(spark, payloads, day=MON):
    """{key: row} for (source, id, payload[, url])."""
    rows = [(p[0], p[1], "Fjord", p[2], p[3] if len(p) > 3 else "", day) for p in payloads]
    return {r["job_id"]: r for r in normalize(bronze_df(spark, rows)).collect()}


def test_fields_of_board_a(spark):
    got = rows_of(
        spark,
        [
            (A, "1", board_a(1, content="<ul><li>Telelavoro</li>\n<li>two  days</li></ul>", absolute_url="https://a/1")),
            (A, "2", board_a(2, location=..., updated_at=..., title=...), "https://given"),
            (A, "3", board_a(3, location={}, content="", updated_at="not a date")),
            (A, "4", board_a(4, location={"name": None}, content="<br/> <p>")),
        ],
    )
    one = got["greenhouse:1"]
    assert (one["title"], one["location"], one["company"], one["description"]) == ("Role 1", "Oslo", "Fjord", "Telelavoro two days")
    assert one["remote"] is True and one["link"] == "https://a/1" and one["publication_date"] == dt.datetime(2025, 2, 20, 7)
    two = got["greenhouse:2"]
    assert (two["title"], two["location"], two["publication_date"], two["link"]) == ("", None, None, "https://given")
    assert got["greenhouse:3"]["publication_date"] is None and got["greenhouse:3"]["description"] is None
    assert got["greenhouse:4"]["location"] is None and got["greenhouse:4"]["description"] is None
    assert {r["reject_reason"] for r in got.values()} == {None}
    assert all(r["salary"] is None and r["technologies"] is None for r in got.values())


def test_fields_of_board_b(spark):
    place = {"city": "Turin", "region": "", "country": "it"}
    got = rows_of(
        spark,
        [
            (B, "1", board_b(1, "<i>kept</i> as is", location=place | {"remote": 1}, applyUrl="https://b/1")),
            (B, "2", board_b(2, location=place | {"remote": 0}, name=..., releasedDate=None)),
            (B, "3", board_b(3, "Smart Working on Fridays", location={"remote": []})),
            (B, "4", board_b(4, location=None, jobAd=None)),
        ],
    )
    one = got["smartrecruiters:1"]
    assert (one["location"], one["remote"], one["description"], one["link"]) == ("Turin, it", True, "<i>kept</i> as is", "https://b/1")
    assert one["publication_date"] == dt.datetime(2025, 2, 21, 9, 30)
    assert got["smartrecruiters:2"]["remote"] is False and got["smartrecruiters:2"]["title"] == ""
    assert got["smartrecruiters:3"]["remote"] is True and got["smartrecruiters:3"]["location"] is None
    assert got["smartrecruiters:4"]["location"] is None and got["smartrecruiters:4"]["description"] is None
    assert {r["reject_reason"] for r in got.values()} == {None}


def test_reject_reasons(spark):
    cases = [
        ("elsewhere", {"id": 1}, "unknown_source:elsewhere"),
        (A, "{", "malformed_json"),
        (A, '{"id": 1} trailing', "malformed_json"),
        (A, "null", "payload_not_object"),
        (A, '"text"', "payload_not_object"),
        (A, board_a(1, title=7), "bad_type:title"),
        (B, board_b(1, name=None), "null_title"),
        (A, board_a(1, location=["Oslo"]), "bad_structure:location"),
        (A, board_a(1, content=[1]), "bad_type:content"),
        (B, board_b(1, location={"city": 4}), "bad_type:location.city"),
        (B, board_b(1, jobAd="soon"), "bad_structure:jobAd"),
        (B, board_b(1, jobAd={"sections": {"jobDescription": 3}}), "bad_structure:jobDescription"),
        (B, board_b(1, releasedDate=20250221), "bad_type:releasedDate"),
    ]
    got = rows_of(spark, [(s, str(i), p) for i, (s, p, _) in enumerate(cases)])
    assert {int(k.split(":")[1]): r["reject_reason"] for k, r in got.items()} == {i: c[2] for i, c in enumerate(cases)}


def test_first_bad_row_can_fail_the_job(spark):
    good, none = split_rejects(normalize(bronze_df(spark, [("elsewhere", "1", "Fjord", {"id": 1}, "", MON)])), "fail")
    assert none.count() == 0
    with pytest.raises(Exception, match="unknown_source"):
        good.collect()
    with pytest.raises(ValueError):
        split_rejects(good, "ignore")


def titles(spark, versions):
    """Titles kept, and reject reasons, for versions (day, payload) of one posting."""
    rows = [(A, "9", "Fjord", p, "", day) for day, p in versions]
    silver, rejects = silver_batch(bronze_df(spark, rows), on_error="quarantine")
    return [r["title"] for r in silver.collect()], sorted(r["reject_reason"] for r in rejects.collect())


def test_which_version_stays(spark):
    late, early = "2025-02-25T00:00:00Z", "2025-02-01T00:00:00Z"
    assert titles(spark, [(MON, board_a(9, title="old")), (TUE, board_a(9, title="new"))]) == (["new"], [])
    later_published = [(MON, board_a(9, title="late", updated_at=late)), (WED, board_a(9, title="early", updated_at=early))]
    assert titles(spark, later_published) == (["late"], [])
    undated = [(WED, board_a(9, title="undated", updated_at=...)), (MON, board_a(9, title="dated", updated_at=early))]
    assert titles(spark, undated) == (["dated"], [])
    assert titles(spark, [(MON, board_a(9, title="whole")), (WED, board_a(9, title=None))]) == (["whole"], ["null_title"])


def test_silver_rows_of_two_boards(spark):
    rows = [
        (A, "1", "Fjord", board_a(1, content="Scala, dbt and k8s"), "u", MON),
        (B, "1", "Delta", board_b(1, "No stack named"), "v", MON),
        (B, "2", "Delta", json.dumps(board_b(2)), "w", TUE),
    ]
    silver, rejects = silver_batch(bronze_df(spark, rows))
    assert silver.columns == SILVER_COLUMNS and rejects.count() == 0
    got = {r["job_id"]: (r["company"], r["technologies"]) for r in silver.collect()}
    assert got == {
        "greenhouse:1": ("Fjord", ["Kubernetes", "Scala", "dbt"]),
        "smartrecruiters:1": ("Delta", []),
        "smartrecruiters:2": ("Delta", []),
    }
