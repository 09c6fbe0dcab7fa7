"""Match scoring (F12-F16, P4): the formula written out in plain Python on
generated cases, and the texts of a few hand-made ones."""

from __future__ import annotations

import itertools
import math

import pytest

from talentflow.functions.terms import extract_technologies
from talentflow.operators.matching import Profile, build_profile, match_scores, profiles_from_frame, profiles_from_text

COLUMNS = (
    "job_id string, company string, title string, location string, remote boolean, link string, "
    "technologies array<string>, description string"
)


def postings(spark, rows):
    """rows: (job_id, technologies list or None, description)."""
    return spark.createDataFrame([(j, "Orbita", "Analyst", None, False, None, t, d) for j, t, d in rows], COLUMNS)


def expected(profile, techs, wanted_years, keywords):
    """(score, matched, missing) of the formula, rounding half to even."""
    need = set(techs or [])
    matched, missing = sorted(need & profile.technologies), sorted(need - profile.technologies)
    ratio = len(matched) / len(need) if need else 0.5
    fit = 1.0
    if wanted_years is not None and profile.years_experience < wanted_years:
        fit = 1.0 + (profile.years_experience - wanted_years) / max(wanted_years, 1.0)
        fit = 0.0 if math.isnan(fit) else max(0.0, fit)
    bonus = min(2 * len(profile.keywords & set(keywords)), 10)
    return max(0, min(100, round((ratio * 0.7 + fit * 0.3) * 100 + bonus))), matched, missing


TECHS = [None, [], ["dbt"], ["Airflow", "dbt", "Scala"], ["Scala", "React", "Git", "Synapse", "AWS", "Kafka", "Docker"], ["dbt", "dbt"]]
YEARS = [None, 0, 1, 4, 9, 40]
PRACTICE = [(), ("Scrum",), ("Scrum", "Mentoring", "Data Governance", "Data Modeling", "Data Warehouse", "DevOps")]
SPELLED = {"Scrum": "scrum", "Mentoring": "mentorship", "Data Governance": "governance", "Data Modeling": "data model", "Data Warehouse": "dwh", "DevOps": "devops"}
PROFILES = [
    Profile({"dbt", "Airflow", "Git"}, {"Scrum", "Data Governance"}, 3.5, "builder"),
    Profile(set(), set(), 0.0, "blank"),
    Profile({"Scala", "Kafka", "React"}, set(PRACTICE[2]), 12.0, "lead"),
]


def test_scores_follow_the_formula(spark):
    cases = list(itertools.product(TECHS, YEARS, PRACTICE))
    text = lambda y, ks: " ".join(["role:"] + [SPELLED[k] for k in ks] + ([f"{y} anni"] if y is not None else []))
    df = postings(spark, [(str(i), t, text(y, ks)) for i, (t, y, ks) in enumerate(cases)])
    rows = match_scores(df, PROFILES, ordered=False).collect()
    assert len(rows) == len(cases) * len(PROFILES)
    by_id = {p.profile_id: p for p in PROFILES}
    for r in rows:
        t, y, ks = cases[int(r["job_id"])]
        want = expected(by_id[r["profile_id"]], t, y, ks)
        assert (r["match_score"], r["matched_skills"], r["missing_skills"]) == want
        assert r["required_years"] == (None if y is None else float(y))


def one(spark, profile, techs, text):
    return match_scores(postings(spark, [("only", techs, text)]), profile, ordered=False).first()


def test_explanation_of_a_surplus_and_keywords(spark):
    r = one(spark, Profile({"Docker", "Git"}, {"Scrum", "CI/CD"}, 9.0), ["Git", "Docker", "Airflow"], "ci/cd, scrum; 6 years")
    assert r["rationale"] == (
        "Copertura tecnologica: 2/3 skill richieste presenti nel CV (67%). "
        "Esperienza richiesta: 6 anni, soddisfatta (margine di +3). "
        "Parole chiave in comune: CI/CD, Scrum."
    )


def test_explanation_of_a_gap_and_of_nothing(spark):
    r = one(spark, Profile({"Git"}, set(), 1.0), ["Git"], "11 anni")
    assert "11 anni, gap di 10 anni rispetto al profilo." in r["rationale"]
    r = one(spark, Profile({"Git"}, set(), 1.0), [], "")
    assert r["rationale"].startswith("Nessuna tecnologia esplicita") and "Nessun requisito esplicito" in r["rationale"]


def test_halves_round_to_even(spark):
    five = ["AWS", "Fabric", "Git", "Scala", "dbt", "React", "Azure", "Synapse"]
    r = one(spark, Profile(set(five[:5]), set(), 6.5), five, "4 years")  # 62.5 % and a margin of 2.5
    assert "(62%)" in r["rationale"] and "margine di +2)" in r["rationale"]


def test_long_numbers_never_stop_the_job(spark):
    p = Profile({"Git"}, set(), 5.0)
    texts = ["3" * 15 + " years", "3" * 45 + " years", "3" * 400 + " years", "0" * 60 + "4 years"]
    rows = match_scores(postings(spark, [(str(i), ["Git"], t) for i, t in enumerate(texts)]), p, ordered=False).collect()
    got = {int(r["job_id"]): r for r in rows}
    for i, t in enumerate(texts):
        assert got[i]["match_score"] == expected(p, ["Git"], float(t.split()[0]), ())[0]
    assert f"richiesta: {'3' * 15} anni" in got[0]["rationale"]
    assert "richiesta: inf anni, gap di inf anni" in got[2]["rationale"]
    endless = one(spark, Profile({"Git"}, set(), float("inf")), ["Git"], "3" * 400 + " years")
    assert endless["match_score"] == 70 and "gap di nan anni" in endless["rationale"]


def test_profile_from_text_scores_its_own_posting_best(spark):
    p = build_profile(spark, "Airflow, dbt and Snowflake in production; scrum; some Terraform", 4.0)
    assert p.technologies == {"Airflow", "dbt", "Snowflake", "Terraform"} and p.keywords == {"Scrum"}
    texts = {"near": "Snowflake with dbt, 2 years", "far": "React and FastAPI, 15 years"}
    df = postings(spark, [(k, None, t) for k, t in texts.items()]).withColumn("technologies", extract_technologies("description"))
    assert [(r["job_id"], r["match_score"]) for r in match_scores(df, p, ordered=True).collect()] == [("near", 100), ("far", 8)]


def test_top_k_per_profile(spark):
    df = postings(spark, [("p", ["dbt"], None), ("q", ["Scala"], None), ("r", ["Scala", "dbt"], None)])
    ps = [Profile({"Scala"}, set(), 1.0, "s"), Profile({"dbt"}, set(), 1.0, "d")]
    rows = match_scores(df, ps, top_k=2).collect()
    assert [(r["profile_id"], r["job_id"], r["match_score"]) for r in rows] == [("d", "p", 100), ("d", "r", 65), ("s", "q", 100), ("s", "r", 65)]


def test_profiles_of_a_frame(spark):
    cvs = spark.createDataFrame(
        [("m", "Docker and git, devops", 7.0), ("n", "only Scala", 0.5)], "profile_id string, cv_text string, years_experience double"
    )
    profiles = profiles_from_frame(profiles_from_text(cvs))
    assert {(p.profile_id, p.technologies, p.keywords) for p in profiles} == {
        ("m", frozenset({"Docker", "Git"}), frozenset({"DevOps"})),
        ("n", frozenset({"Scala"}), frozenset()),
    }
    with pytest.raises(ValueError):
        profiles_from_frame(profiles_from_text(cvs), limit=1)
