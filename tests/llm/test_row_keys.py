"""Rows with null ids and doubled rows through every stage, by content."""

from __future__ import annotations

from collections import Counter

import pytest

from talentflow.llm import decontaminate, exact_dedup, ngram_join, quality
from talentflow.llm.common import ROW, with_row_key

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon phi chi psi omega".split()
LONG = " ".join(WORDS * 3)
NEAR = LONG.replace("iota", "jota", 1)
SCHEMA = "doc_id long, text string, n int"


@pytest.fixture(params=["frame", "files"])
def table(request, spark, tmp_path):
    def make(rows):
        df = spark.createDataFrame(rows, SCHEMA)
        if request.param == "frame":
            return df
        df.repartition(3).write.parquet(f"{tmp_path}/t")
        return spark.read.parquet(f"{tmp_path}/t")

    return make


def content(df):
    return Counter((r.doc_id, r.text) for r in df.collect())


def test_row_keys_are_unique_and_stable(table):
    df = with_row_key(table([(None, "a", 1), (None, "a", 1), (1, "b", 2), (1, "b", 2), (None, None, None)]))
    first = {r[ROW]: (r.doc_id, r.text) for r in df.collect()}
    assert len(first) == 5
    assert {r[ROW]: r.doc_id for r in df.select(ROW, "doc_id").collect()} == {k: v[0] for k, v in first.items()}


def test_exact_dedup_keeps_one_per_text(table):
    rows = [(None, "n n", 1), (None, "nn", 2), (None, "m", 3), (7, "m", 3), (5, "d", 4), (5, "d", 4), (9, "one", 5), (None, "two", 6)]
    df = table(rows)
    kept = exact_dedup.exact_dedup(df)
    assert kept.columns == df.columns
    assert content(kept) == Counter([(None, "n n"), (7, "m"), (5, "d"), (9, "one"), (None, "two")])
    report = Counter((r.doc_id, r.keep_id, r.group_size, r.kept) for r in exact_dedup.dedup_report(df).collect())
    assert report == Counter(
        [(None, None, 2, True), (None, None, 2, False), (None, 7, 2, False), (7, 7, 2, True), (5, 5, 2, True), (5, 5, 2, False)]
        + [(9, 9, 1, True), (None, None, 1, True)]
    )


def test_near_duplicates_keep_one_per_group(table):
    other = " ".join(reversed(WORDS * 3))
    df = table([(None, LONG, 1), (None, NEAR, 2), (3, LONG, 3), (3, LONG, 3), (None, other, 4), (None, other, 4), (8, "", 5), (None, None, 6)])
    kept = ngram_join.drop_near_duplicates(df)
    assert kept.columns == df.columns
    assert content(kept) == Counter([(3, LONG), (None, other), (8, ""), (None, None)])


def test_rejected_and_leaked_rows_without_id_go(spark, table):
    train = spark.createDataFrame(
        [(i, ("good line of words.\n" if i % 2 else "!!! ### $$$ bad idiot\n") * (1 + i % 4), i % 2) for i in range(40)],
        "doc_id long, text string, label int",
    )
    model = quality.fit(train, train.select("doc_id", "label"))
    good, bad = "good line of words.\n" * 2, "!!! ### $$$ bad idiot\n" * 2
    df = table([(None, good, 1), (None, bad, 2), (4, bad, 3), (4, good, 4), (4, good, 4), (None, "leak " + LONG, 5)])
    kept = quality.keep_good(df, model)
    assert kept.columns == df.columns and kept.schema == df.schema
    assert content(kept)[(None, bad)] == content(kept)[(4, bad)] == 0
    assert content(kept)[(None, good)] == 1 and content(kept)[(4, good)] == 2
    bench = spark.createDataFrame([(1, LONG)], "item_id long, text string")
    clean = decontaminate.drop_leaked(df, bench)
    assert clean.columns == df.columns
    assert content(clean) == content(df) - Counter([(None, "leak " + LONG)])


ODD = [
    (None, "start " + LONG + LONG, 1),
    (None, "other " + LONG + LONG, 1),
    (1, LONG * 9 + " tail of the first", 2),
    (1, "b", 2),
    (1, "short " + LONG, 2),
    (7, "one of " + " ".join(str(i) for i in range(300)), 3),
    (7, "one of " + " ".join(str(i) for i in range(300)), 3),
    (9, None, 4),
    (9, "", 4),
    (None, None, 4),
]


def unique_ids(rows):
    """The same texts under ids of their own, in the order of the contract."""
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0))
    return [(n, *rows[i][1:]) for n, i in enumerate(order)], [rows[i][0] for i in order]


def columns_of(df, *names):
    return Counter(tuple(r[n] for n in names) for r in df.collect())


def clashing(df):
    return df.selectExpr("*", "1 as _row_key", "2 as _row_file", "3 as `row`", "'x' as `a.b`", "4 as place", "5 as start", "6 as bands")


def test_reports_take_null_and_repeated_ids(spark, table):
    from talentflow.llm import countmin, secrets, suffix_array

    rows = [(i, t and t + " key=9F86D081884C7D659A2FEAA0C55AD015A3BF4F1B" * (i == 1), n) for i, t, n in ODD]
    own, ids = unique_ids(rows)
    apart = spark.createDataFrame(own, SCHEMA)
    df = clashing(table(rows))
    for report, names in (
        (lambda d: suffix_array.remove_repeats(d, texts=False), ("n_bytes", "n_removed", "n_spans", "kept_sha256")),
        (lambda d: secrets.secret_report(d), ("n_assign", "n_access", "n_hex", "base_sha256", "spans")),
        (lambda d: ngram_join.near_duplicates(d), ("n_links",)),
    ):
        want = Counter((ids[r.doc_id], *(r[n] for n in names)) for r in report(apart).collect())
        assert columns_of(report(df), "doc_id", *names) == want
    # Which of several rows with one id is the earlier one depends on the row keys: totals are the same.
    got, want = (countmin.remove_repeats(d, texts=False).toPandas() for d in (df, apart))
    want["doc_id"] = [ids[i] for i in want.doc_id]
    assert got.n_removed.sum() == want.n_removed.sum() > 0
    assert sorted(zip(got.doc_id.fillna(-1), got.n_words)) == sorted(zip(want.doc_id.fillna(-1), want.n_words))


def test_links_of_rows_with_one_id(spark, table):
    df = table([(1, LONG, 1), (1, "quite another text", 1), (2, NEAR, 1), (None, LONG, 1), (None, "  ", 1), (3, "no ids " * 9, 1)])
    got = columns_of(ngram_join.near_duplicates(df), "doc_id", "class_id", "copy_of", "n_links")
    assert got == Counter(
        [(1, 1, 1, 2), (2, 1, 2, 2), (None, 1, 1, 2), (1, 1, 1, 0), (None, None, None, 0), (3, 3, 3, 0)]
    )


def test_stages_keep_columns_of_any_name(spark, table):
    df = clashing(table([(1, LONG, 1), (2, LONG, 2), (3, NEAR, 3), (4, "leak " + LONG, 4), (5, "clean words", 5)]))
    bench = spark.createDataFrame([(1, LONG)], "item_id long, text string")
    for stage, stay in (
        (exact_dedup.exact_dedup, [1, 3, 4, 5]),
        (ngram_join.drop_near_duplicates, [1, 5]),
        (lambda d: decontaminate.drop_leaked(d, bench), [5]),
    ):
        kept = stage(df)
        assert kept.columns == df.columns
        assert sorted(r.doc_id for r in kept.collect()) == stay
