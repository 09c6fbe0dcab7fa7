"""Gold views."""

from __future__ import annotations

import datetime as dt

from talentflow.operators import views

from .conftest import bronze_df


def silver(spark, rows):
    """rows: (job_id, company, title, source, technologies)."""
    return spark.createDataFrame(
        [(j, c, t, s, f"https://x/{j}", techs) for j, c, t, s, techs in rows],
        "job_id string, company string, title string, source string, link string, technologies array<string>",
    )


ROWS = [
    ("g:1", "Orbita", "Night  Guard", "g", ["Kafka", "dbt"]),
    ("s:1", "Orbita", " night guard", "s", ["dbt"]),
    ("g:2", "Orbita", "NIGHT\tGUARD", "g", []),
    ("g:3", "Delta", "night guard", "g", None),
    ("g:4", "Delta", "Cook", "g", ["Kafka"]),
    ("g:5", "Delta", "cook", "g", ["Scala", "dbt"]),
    ("g:6", None, None, "g", ["dbt"]),
    ("s:6", None, None, "s", []),
    ("g:7", None, "Orbita", "g", []),
    ("g:8", "Orbita", None, "g", []),
]


def test_duplicates_share_company_and_title(spark):
    want = {"g:1": 3, "s:1": 3, "g:2": 3, "g:4": 2, "g:5": 2, "g:6": 2, "s:6": 2}
    s = silver(spark, ROWS)
    assert {r["job_id"]: r["duplicate_count"] for r in views.duplicate_postings(s).collect()} == want
    across = {r["job_id"] for r in views.duplicate_postings(s, cross_source_only=True).collect()}
    assert across == {"g:1", "s:1", "g:2", "g:6", "s:6"}
    assert views.duplicate_postings(s.limit(0)).count() == 0


def test_duplicates_in_order(spark):
    rows = views.duplicate_postings(silver(spark, ROWS), ordered=True).collect()
    key = lambda r: (r["company"] is not None, r["company"] or "", r["title"] or "", r["job_id"])
    assert rows == sorted(rows, key=key) and len(rows) == 7


def test_a_hot_title_is_counted_whole(spark):
    s = silver(spark, [(f"g:{i}", "Orbita", "Clerk" if i % 3 else f"Clerk {i}", "g", []) for i in range(900)])
    got = views.duplicate_postings(s).collect()
    assert len(got) == 600 and {r["duplicate_count"] for r in got} == {600}


def test_active_companies_in_order(spark):
    s = silver(spark, ROWS)
    rows = [tuple(r) for r in views.active_companies(s).collect()]
    assert rows == [("Orbita", 4, 2), (None, 3, 2), ("Delta", 3, 1)]
    gone = spark.createDataFrame([("g:1",), ("g:2",), ("nowhere",)], "job_id string")
    rows = [tuple(r) for r in views.active_companies(s, removed=gone).collect()]
    assert rows == [(None, 3, 2), ("Delta", 3, 1), ("Orbita", 2, 2)]


def test_tech_trends_in_order(spark):
    rows = [tuple(r) for r in views.tech_trends(silver(spark, ROWS)).collect()]
    assert rows == [("dbt", 4), ("Kafka", 2), ("Scala", 1)]
    assert views.tech_trends(silver(spark, ROWS[2:4])).count() == 0


def _bronze(spark, batches):
    rows = []
    for day, ids in batches:
        rows += [("greenhouse", i, "acme", {"id": i}, "", day) for i in ids]
    return bronze_df(spark, rows)


MON, TUE = dt.date(2025, 3, 3), dt.date(2025, 3, 4)


def test_new_and_removed(spark):
    b = _bronze(spark, [(MON, ["a", "b", "b"]), (TUE, ["b", "c", "c"]), (dt.date(2025, 3, 1), ["z"])])
    assert [tuple(r) for r in views.new_postings(b, MON, TUE).collect()] == [("greenhouse:c", TUE)]
    assert [tuple(r) for r in views.removed_postings(b, MON, TUE).collect()] == [("greenhouse:a", TUE)]
    same = _bronze(spark, [(MON, ["a"]), (TUE, ["a"])])
    assert views.new_postings(same, MON, TUE).count() == 0 == views.removed_postings(same, MON, TUE).count()
    assert sorted(r["job_id"] for r in views.batch_job_ids(b, MON).collect()) == ["greenhouse:a", "greenhouse:b"]


def test_removed_only_where_the_target_was_fetched(spark):
    post = lambda i, company, day: ("greenhouse", i, company, {"id": i}, "", day)
    b = bronze_df(
        spark,
        [post("1", "Fjord", MON), post("2", "Fjord", MON), post("3", "Delta", MON), post("4", "Moved", MON)]
        + [post("1", "Fjord", TUE), post("4", "Fjord", TUE), post("9", "Fresh", TUE)],
    )
    ids = lambda df: sorted(r["job_id"] for r in df.collect())
    assert ids(views.removed_postings(b, MON, TUE)) == ["greenhouse:2", "greenhouse:3"]
    assert ids(views.removed_postings(b, MON, TUE, only_fetched_targets=True)) == ["greenhouse:2"]
