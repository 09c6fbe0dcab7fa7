"""Term lookup with a catalog table, held against the regular-expression form."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from talentflow.catalogs import KEYWORD_CATALOG, TECHNOLOGY_CATALOG
from talentflow.functions.terms import extract_terms
from talentflow.operators import term_lookup
from talentflow.operators.term_lookup import catalog_frame, catalog_trends, term_mentions, with_terms

from .conftest import one_col
from .test_terms import SENTENCES, plain

SYMBOLS = {
    "Dot": [".net"], "Plus": ["c++"], "Sharp": ["c#", "f#"], "Word": ["go"], "Eszett": ["straße"], "SS": ["strasse"],
    "Sigma": ["οδοσ"], "Kelvin": ["kilo k"], "Dotless": ["istanbul"], "Long": ["a b c d e f g"], "Gap": ["x - y", "x--y"],
    "Deseret": ["\U00010428\U00010429"], "Upper": ["SHOUT"], "Blank": [" "], "Dash": ["-"],
}


def both(spark, texts, catalog):
    df = one_col(spark, texts).coalesce(1)
    got = with_terms(df.select("t", F.monotonically_increasing_id().alias("i")), "t", catalog_frame(spark, catalog))
    want = df.select(extract_terms("t", catalog).alias("x")).collect()
    return [r["terms"] for r in got.orderBy("i").collect()], [r["x"] for r in want]


def test_sentences_agree_with_the_expressions(spark):
    for catalog in (TECHNOLOGY_CATALOG, KEYWORD_CATALOG):
        got, want = both(spark, SENTENCES, catalog)
        assert got == want


def test_odd_strings_agree_with_python(spark):
    rng = random.Random(7)
    bits = [
        "c++", "c#", ".net", "asp", "go", "GO", "straße", "STRASSE", "ΟΔΟΣ", "οδος", "K", "kilo", "İstanbul", "ıSTANBUL",
        "a", "b c", "d e", "f g", "x", "y", "-", "--", " ", "  ", "\n", "\t", "_", "́", "‍", "\U00010400\U00010401", "shout", "9", "٣", "中",
    ]
    texts = ["".join(rng.choice(bits + [" "] * 8) for _ in range(rng.randrange(0, 16))) for _ in range(4000)] + [None, ""]
    got, expressions = both(spark, texts, SYMBOLS)
    want = [plain(t, SYMBOLS) for t in texts]
    assert got == want
    # the expression takes half of a letter beyond U+FFFF before a name for a non-word character
    high = ["\U00010400" in (t or "") for t in texts]
    assert all(x == w for x, w, h in zip(expressions, want, high) if not h)
    assert {n for names in want for n in names} >= set(SYMBOLS) - {"Long"}


def hundred_thousand():
    return {f"Name {i}": [f"tool{i}", f"kit {i} pro"] for i in range(100_000)}


def test_a_hundred_thousand_names(spark):
    names = hundred_thousand()
    catalog = spark.range(100_000).select(
        F.concat(F.lit("Name "), "id").alias("name"),
        F.explode(F.array(F.concat(F.lit("tool"), "id"), F.concat(F.lit("kit "), "id", F.lit(" pro")))).alias("variant"),
    )
    rng = random.Random(3)
    picks = [[rng.randrange(100_000) for _ in range(5)] for _ in range(50)]
    texts = [f"TOOL{a}, kit {b} pro; xtool{c} kit {d}  pro (Kit {e} PRO)" for a, b, c, d, e in picks]
    got = [r["terms"] for r in with_terms(one_col(spark, texts).coalesce(1).withColumn("i", F.monotonically_increasing_id()), "t", catalog).orderBy("i").collect()]
    some = {f"Name {i}": names[f"Name {i}"] for row in picks for i in row}
    want = [r["x"] for r in one_col(spark, texts).coalesce(1).select(extract_terms("t", some).alias("x")).collect()]
    assert got == want and all(want)


def test_a_catalog_too_large_to_broadcast(spark, monkeypatch):
    want, _ = both(spark, SENTENCES, TECHNOLOGY_CATALOG)
    monkeypatch.setattr(term_lookup, "BROADCAST_ROWS", 1)
    got, _ = both(spark, SENTENCES, TECHNOLOGY_CATALOG)
    assert got == want


def test_rows_and_catalogs_of_any_kind(spark):
    catalog = spark.createDataFrame([("B", "two"), ("A", "two"), ("A", "two"), (None, "two"), ("C", None), ("D", ""), ("", "two")], "name string, variant string")
    rows = spark.createDataFrame([(1, "Two"), (1, "Two"), (None, "two, two"), (None, None), (2, "")], "id int, t string")
    got = with_terms(rows, "t", catalog, out="found")
    assert got.columns == ["id", "t", "found"]
    assert sorted((str(r[0]), str(r[1]), r[2]) for r in got.collect()) == [
        ("1", "Two", ["A", "B"]), ("1", "Two", ["A", "B"]), ("2", "", []), ("None", "None", []), ("None", "two, two", ["A", "B"]),
    ]
    assert with_terms(rows, "t", catalog.limit(0)).filter("size(terms) > 0").count() == 0
    assert with_terms(rows.limit(0), "t", catalog).count() == 0
    trends = {r["name"]: r["mentions_count"] for r in catalog_trends(rows.filter("id = 1 or t = 'two, two'"), "id", "t", catalog).collect()}
    assert trends == {"A": 2, "B": 2}  # keys 1 and null


def test_a_very_long_text(spark):
    text = "lorem ipsum " * 200_000 + "Kafka"
    rows = one_col(spark, [text]).withColumn("id", F.lit(1))
    assert [r["name"] for r in term_mentions(rows, "id", "t", catalog_frame(spark, TECHNOLOGY_CATALOG)).collect()] == ["Kafka"]
