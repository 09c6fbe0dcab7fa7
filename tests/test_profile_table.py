"""Tables of profiles: the blocked join against one literal profile at a time."""

from __future__ import annotations

import random
from collections import Counter, defaultdict

import pytest

from talentflow.operators import matching
from talentflow.operators.matching import MATCH_COLUMNS, Profile, match_profile_table, match_scores

POSTING = "job_id string, company string, title string, location string, remote boolean, link string, technologies array<string>, description string"
PROFILE = "profile_id string, technologies array<string>, keywords array<string>, years_experience double"
TECHS = ["Python", "SQL", "Spark", "Docker", "AWS", "Java"]


def postings_of(spark, rnd, n):
    texts = ["3+ years of experience, agile", "remote friendly", None, "", "at least 5 years. Agile and CI/CD", "10 years of experience"]
    rows = []
    for i in range(n):
        techs = rnd.choice([None, [], rnd.sample(TECHS, rnd.randint(1, 4))])
        rows.append((f"j{rnd.randint(0, 10**6):07d}-{i}", f"c{i % 7}", f"t{i}", None, None, f"l{i}", techs, rnd.choice(texts)))
    return spark.createDataFrame(rows, POSTING)


@pytest.mark.parametrize("k,block,chunk", [(3, 256, 4096), (1, 2, 3), (7, 3, 1)])
def test_equals_literal_profiles(spark, k, block, chunk):
    rnd = random.Random(k)
    posts = postings_of(spark, rnd, 60)
    profiles = [(f"p{i}", rnd.sample(TECHS, rnd.randint(0, 5)), rnd.choice([None, [], ["Agile"], ["CI/CD", "Agile"]]), rnd.choice([0.0, 4.0, 12.5])) for i in range(12)]
    got = defaultdict(list)
    for r in match_profile_table(posts, spark.createDataFrame(profiles, PROFILE), k, block, chunk).collect():
        got[r.profile_id].append((r["rank"], *(r[c] for c in MATCH_COLUMNS)))
    for pid, techs, kws, years in profiles:
        want = match_scores(posts, Profile(frozenset(techs), frozenset(kws or ()), years), top_k=k).collect()
        assert sorted(got[pid]) == [(n + 1, *(r[c] for c in MATCH_COLUMNS)) for n, r in enumerate(want)]


def test_null_and_repeated_ids(spark):
    posts = postings_of(spark, random.Random(9), 10)
    rows = [(None, ["Python", None, "Python"], None, None), (None, None, None, 3.0), ("a", ["SQL"], [], 1.0), ("b", ["SQL"], [], 1.0)]
    rows += [("b", ["SQL", "SQL"], [None], 1.0), ("b", ["Java"], [], 1.0), ("c", ["Java"], [], 1.0)]
    out = match_profile_table(posts, spark.createDataFrame(rows, PROFILE), 2, block=2)
    assert Counter(r.profile_id for r in out.collect()) == Counter({None: 4, "a": 2, "b": 6, "c": 2})
    one = {(r.profile_id, r["rank"]): r.job_id for r in out.filter("profile_id in ('a', 'c')").collect()}
    both = Counter((r["rank"], r.job_id) for r in out.filter("profile_id = 'b'").collect())
    assert both == Counter({(1, one["a", 1]): 2, (2, one["a", 2]): 2}) + Counter({(1, one["c", 1]): 1, (2, one["c", 2]): 1})


def test_empty_sides(spark):
    posts, profiles = postings_of(spark, random.Random(1), 4), spark.createDataFrame([("a", ["SQL"], [], 1.0)], PROFILE)
    assert match_profile_table(posts.limit(0), profiles, 2).count() == 0
    empty = match_profile_table(posts, profiles.limit(0), 2)
    assert empty.count() == 0 and empty.columns == ["profile_id", *MATCH_COLUMNS, "rank"]


def test_a_hundred_thousand_profiles(spark):
    posts = postings_of(spark, random.Random(2), 200)
    pool = ", ".join(f"'{t}'" for t in TECHS)
    profiles = spark.range(100_000).selectExpr(
        "concat('p', id) as profile_id",
        f"filter(array({pool}), (x, i) -> shiftright(id, i) % 2 = 1) as technologies",
        "if(id % 3 = 0, array('Agile'), array()) as keywords",
        "double(id % 10) as years_experience",
    )
    out = match_profile_table(posts, profiles, 5)
    assert out.count() == 500_000
    plan = out._jdf.queryExecution().analyzed().toString()
    assert len(plan.splitlines()) < 400 and "Union" not in plan
    some = ["p0", "p7", "p41234", "p99999"]
    rows = {(r.profile_id, r["rank"]): (r.job_id, r.match_score) for r in out.filter(out.profile_id.isin(some)).collect()}
    for r in profiles.filter(profiles.profile_id.isin(some)).collect():
        want = match_scores(posts, Profile(frozenset(r.technologies), frozenset(r.keywords), r.years_experience), top_k=5).collect()
        assert [rows[r.profile_id, n + 1] for n in range(5)] == [(w.job_id, w.match_score) for w in want]


def test_only_near_kinds_meet(spark):
    """Posting kinds that cannot be among the best are not scored against a profile."""
    rnd = random.Random(5)
    posts = spark.createDataFrame(
        [(f"j{i}", None, None, None, None, None, rnd.sample(TECHS, rnd.randint(0, 4)), f"{rnd.randint(0, 30)} years" + " agile" * (i % 2)) for i in range(600)],
        POSTING,
    )
    rows = [(f"p{i}", rnd.sample(TECHS, rnd.randint(0, 5)), rnd.choice([[], ["Agile"], ["Agile", "CI/CD"]]), float(rnd.randint(-1, 20))) for i in range(80)]
    profiles = spark.createDataFrame(rows, PROFILE)
    _, kinds = matching.profile_kinds(profiles)
    kinds, kinds_of_posts = kinds.localCheckpoint(), matching.posting_kinds(posts, 3).localCheckpoint()
    pairs = matching.near_pairs(kinds, kinds_of_posts, 3)
    assert pairs.select("_sig").distinct().count() == kinds.count()
    assert 3 * kinds.count() <= pairs.count() < 0.2 * kinds.count() * kinds_of_posts.count()
    got = {(r.profile_id, r["rank"]): (r.job_id, r.match_score) for r in match_profile_table(posts, profiles, 3).collect()}
    want = match_scores(posts, [Profile(frozenset(t), frozenset(k), y, p) for p, t, k, y in rows], top_k=3).collect()
    for pid, *_ in rows:
        best = sorted(((r.job_id, r.match_score) for r in want if r.profile_id == pid), key=lambda x: (-x[1], x[0]))
        assert [got[pid, n + 1] for n in range(3)] == best


def test_more_wanted_than_there_are(spark):
    posts = postings_of(spark, random.Random(4), 20)
    profiles = spark.createDataFrame([("a", ["SQL"], ["Agile"], 4.0), ("b", [], None, None)], PROFILE)
    assert Counter(r.profile_id for r in match_profile_table(posts, profiles, 50).collect()) == Counter(a=20, b=20)
