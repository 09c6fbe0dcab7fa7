"""Plan-shaping helpers: parallelism guard, memoised expressions, limits."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from talentflow.functions.arrays import explode_rows
from talentflow.functions.memo import per_context
from talentflow.operators.matching import MAX_LITERAL_PROFILES, Profile, match_profile_table, match_scores
from talentflow.plans.derived import ensure_parallelism


def test_inputs_spread_only_where_the_session_asks(spark):
    one = spark.range(100).coalesce(1)
    assert ensure_parallelism(one) is one
    spark.conf.set("spark.talentflow.spreadInputs", "5")
    try:
        assert ensure_parallelism(one).rdd.getNumPartitions() == 5
    finally:
        spark.conf.unset("spark.talentflow.spreadInputs")


def test_profile_tables_are_taken_in_blocks(spark):
    posts = spark.createDataFrame(
        [(f"p{i}", ["dbt"] if i % 2 else ["Scala"], None) for i in range(6)], "job_id string, technologies array<string>, description string"
    ).selectExpr("job_id", "'c' company", "'t' title", "'l' location", "false remote", "'u' link", "technologies", "description")
    profiles = spark.createDataFrame(
        [(f"u{i:02d}", ["dbt"] if i % 3 else ["Scala"], [], 1.0) for i in range(11)],
        "profile_id string, technologies array<string>, keywords array<string>, years_experience double",
    )
    rows = [match_profile_table(posts, profiles, 2, block=n).collect() for n in (4, 11, 256)]
    keyed = [sorted((r["profile_id"], r["rank"], r["job_id"], r["match_score"]) for r in part) for part in rows]
    assert keyed[0] == keyed[1] == keyed[2] and len(keyed[0]) == 22
    assert ("u00", 1, "p0", 100) in keyed[0] and ("u01", 2, "p3", 100) in keyed[0]
    assert match_profile_table(posts, profiles.limit(0), 2).count() == 0


def test_memo_reuses_columns_within_a_context(spark):
    calls = []

    @per_context
    def build(n: int):
        calls.append(n)
        return F.lit(n)

    assert build(1) is build(1) and calls == [1]
    build(2)
    assert calls == [1, 2]


def test_explode_rows_matches_explode(spark):
    df = spark.createDataFrame([(1, ["a", None]), (2, []), (3, None)], "k int, xs array<string>")
    key = lambda t: (t[0], t[1] or "")
    got = sorted(((r["k"], r["x"]) for r in explode_rows(df, F.col("xs"), "x", keep=["k"]).collect()), key=key)
    exp = sorted(((r["k"], r["x"]) for r in df.select("k", F.explode("xs").alias("x")).collect()), key=key)
    assert got == exp == [(1, None), (1, "a")]


def test_profile_limits(spark):
    df = spark.createDataFrame([], "job_id string, company string, title string, location string, remote boolean, "
                                   "link string, technologies array<string>, description string")
    with pytest.raises(ValueError):
        match_scores(df, [])
    with pytest.raises(ValueError):
        match_scores(df, [Profile(set(), set(), 1.0, "a"), Profile(set(), set(), 1.0, "a")])
    too_many = [Profile(set(), set(), 1.0, str(i)) for i in range(MAX_LITERAL_PROFILES + 1)]
    with pytest.raises(ValueError):
        match_scores(df, too_many)


def test_scoring_has_no_join_or_shuffle(spark):
    df = spark.createDataFrame([("j", "c", "t", None, False, None, ["Spark"], "5+ years")],
                               "job_id string, company string, title string, location string, remote boolean, "
                               "link string, technologies array<string>, description string")
    plan = match_scores(df, [Profile({"Spark"}, set(), 5.0, "a"), Profile(set(), set(), 1.0, "b")], ordered=False) \
        ._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan


def test_checkpoint_dir_from_session_is_kept(spark):
    from talentflow.session import ensure_checkpoint_dir, scratch_path

    current = ensure_checkpoint_dir(spark)
    assert ensure_checkpoint_dir(spark) == current
    assert scratch_path(spark, "a", "b") == current.rstrip("/") + "/a/b"


def test_target_gate_broadcasts_only_under_the_bound(spark, monkeypatch):
    from talentflow.sources import landing

    resp = spark.createDataFrame([("greenhouse", "a", None, '{"jobs": [{"id": 1}]}')],
                                 "source string, company_identifier string, fetched_at timestamp, body string")
    targets = landing.targets_frame(spark, [("greenhouse", "a", "none"), ("greenhouse", "b", "low"), ("greenhouse", "c", "excluded")])

    def hinted(df):
        return "broadcast" in df._jdf.queryExecution().analyzed().toString().lower() or \
            "ResolvedHint" in df._jdf.queryExecution().analyzed().toString()

    assert hinted(landing.gate_targets(resp, targets))
    monkeypatch.setattr(landing, "MAX_BROADCAST_TARGETS", 1)
    assert not hinted(landing.gate_targets(resp, targets))
    assert landing.gate_targets(resp, targets).count() == 1


def test_postings_of_one_row_group_are_spread(spark, tmp_dir, monkeypatch):
    """One file of one row group is dealt over bounded tasks, null and repeated keys too."""
    from talentflow.plans import derived, queries

    rows = [(None if i % 3 == 0 else i // 2, f"part {i}", "b", "t", i % 50) for i in range(2000)]
    part = spark.createDataFrame(rows, "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int")
    part.coalesce(1).write.parquet(f"{tmp_dir}/part.parquet")
    monkeypatch.setattr(derived, "SPREAD_ROWS", 100)
    for query, each in ((queries.q_match_scores, len(queries.FLAGSHIP_PROFILES)), (lambda s, d: derived.part_postings(s, d), 1)):
        out = query(spark, tmp_dir)
        sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(sizes) == 2000 * each and max(sizes) < 300 * each


def test_only_the_best_are_explained(spark):
    """The per-profile limit comes before the explanation text."""
    df = spark.createDataFrame([("j", "c", "t", None, False, None, ["Spark"], "5+ years")],
                               "job_id string, company string, title string, location string, remote boolean, "
                               "link string, technologies array<string>, description string")
    best = match_scores(df, [Profile({"Spark"}, set(), 5.0, "a"), Profile(set(), set(), 1.0, "b")], top_k=1)
    plan = best._jdf.queryExecution().optimizedPlan().toString().splitlines()
    first = lambda word: next(i for i, line in enumerate(plan) if word in line)
    assert first("rationale") < first("Window") and not any("Copertura" in line for line in plan[first("Window"):])
    assert best.columns[0] == "profile_id" and best.columns[-1] == "rationale" and best.count() == 2
