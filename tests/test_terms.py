"""Term extraction (F9, F10) and required years (F11), each held against
Python's ``re`` on the same texts."""

from __future__ import annotations

import random
import re
import time

from pyspark.sql import functions as F

from talentflow.catalogs import KEYWORD_CATALOG, TECHNOLOGY_CATALOG
from talentflow.functions.terms import extract_technologies, extract_terms, required_years

from .conftest import one_col


def found(spark, texts, catalog=TECHNOLOGY_CATALOG, **options):
    rows = one_col(spark, texts).select("t", extract_terms("t", catalog, **options).alias("x")).collect()
    return [r["x"] for r in rows]


def plain(text, catalog=TECHNOLOGY_CATALOG):
    """Canonical names with a variant between Python word boundaries."""
    hit = lambda v: re.search(rf"\b{re.escape(v)}\b", text or "", re.I)
    return sorted(name for name, variants in catalog.items() if any(hit(v) for v in variants))


SENTENCES = [
    "Airflow DAGs feed Snowflake; dbt builds the marts.",
    "k8s or KUBERNETES, GitLab runners, mssql on the side",
    "graphql nosql airflows dbts pysparkling fastapis",
    "react.js / reactjs / react, PL/SQL and t-sql!",
    "(Scala)[FastAPI]{Streamlit}<Docker>",
    "snake_sql sql_snake sql-9 9sql SQL9",
    "amazon web services, amazon  web services, amazon\nweb services",
    "",
    None,
    "nothing of the kind here",
    "Terraform,Terraform;terraform",
    "powerbi POWER BI Power-BI",
]


def test_names_agree_with_python_boundaries(spark):
    assert found(spark, SENTENCES) == [plain(t) for t in SENTENCES]
    assert found(spark, SENTENCES, KEYWORD_CATALOG) == [plain(t, KEYWORD_CATALOG) for t in SENTENCES]


def test_every_variant_is_found_in_any_case(spark):
    for catalog in (TECHNOLOGY_CATALOG, KEYWORD_CATALOG):
        variants = [(name, v) for name, vs in catalog.items() for v in vs]
        texts = [f"x {v.upper()}, {v.title()}." for _, v in variants]
        assert all(name in got for (name, _), got in zip(variants, found(spark, texts, catalog)))


def test_joiners_marks_and_other_scripts(spark):
    marks = ["‍", "‌", "́", "­", "²", "٣", "෴", "ß", "_", "中", "Ⅰ"]
    texts = [t for m in marks for t in (f"kafka{m}", f"{m}kafka", f"{m}sql{m} git")]
    assert found(spark, texts) == [plain(t) for t in texts]


def test_variants_with_symbols_at_the_edge(spark):
    catalog = {"Dot": [".net"], "Plus": ["c++"], "Sharp": ["c#", "f#"], "Word": ["go"]}
    texts = ["asp.net", " .net", "c++", "c++x", "c#", "xf#y", "go.net go", "é.net c#é"]
    assert found(spark, texts, catalog) == [plain(t, catalog) for t in texts]


def test_guard_changes_nothing(spark):
    assert found(spark, SENTENCES, guard=True) == found(spark, SENTENCES)
    df = one_col(spark, SENTENCES).select(extract_technologies("t").alias("a"), extract_technologies(F.col("t")).alias("b"))
    assert all(r["a"] == r["b"] == sorted(set(r["a"])) for r in df.collect())


YEARS = re.compile(r"(\d+)\s*(?:\+)?\s*(?:-\s*\d+\s*)?\s*(?:years?|anni)\b", re.I)


def years(spark, texts):
    return [r["y"] for r in one_col(spark, texts).select(required_years("t").alias("y")).collect()]


def test_years_agree_with_python(spark):
    rng = random.Random(20)
    bits = ["7", "18", "250", " ", "   ", "\t", "\n", "+", "-", "years", "year", "anni", "YeArS", "q", "_", "́", "‍", "٤", "　"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randrange(1, 10))) for _ in range(4000)] + [None, ""]
    want = [float(m.group(1)) if (m := YEARS.search(t or "")) else None for t in texts]
    assert years(spark, texts) == want


def test_years_are_linear_in_white_space(spark):
    texts = ["6" + " " * 100_000, "6 " * 30_000, "6" + " " * 100_000 + "anni", "9-" * 40_000, "1" * 100_000]
    began = time.time()
    assert years(spark, texts) == [None, None, 6.0, None, None]
    assert time.time() - began < 30


def test_very_long_numbers(spark):
    assert years(spark, ["7" * 45 + " years", "7" * 400 + " anni"]) == [float("7" * 45), float("inf")]
