"""Multiset fingerprints against a plain form, and their algebra."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from talentflow.llm import fingerprints as fp

SCHEMA = "doc_id long, text string"
BLANKS = " \t\n\x0b\x0c\r"


def sums_of(text):
    units = [p.strip(BLANKS) for p in re.sub(r"([.!?])[ \t\n\x0B\f\r]+", "\\1\n", text).split("\n")]
    words, signs = [0] * 8, [0] * 128
    for unit in filter(None, units):
        digest = hashlib.sha256(unit.encode()).digest()
        numbers = [int.from_bytes(digest[4 * k : 4 * k + 4], "big") for k in range(8)]
        words = [(a + b) % 2**32 for a, b in zip(words, numbers)]
        signs = [a + (1 if numbers[j // 32] >> (j % 32) & 1 else -1) for j, a in enumerate(signs)]
    return words, [(s + 2**15) % 2**16 - 2**15 for s in signs]


def printed(sums):
    return "".join(f"{w:08x}" for w in sums[0]) + "".join(f"{s % 2**16:04x}" for s in sums[1])


def like(a, b):
    if a == b:
        return 1.0
    apart = sum(((x - y + 2**15) % 2**16 - 2**15) ** 2 for x, y in zip(a, b))
    return max(0.0, 1 - apart / (sum(x * x for x in a) + sum(y * y for y in b)))


def plain(rows):
    """Rows in their order; equal ids must have equal texts."""
    texts = ["" if t is None else t for _, t in rows]
    out = []
    for (i, _), t, nxt in zip(rows, texts, texts[1:] + texts[:1]):
        n = len(t)
        edited = t[: n - n // 4] + nxt[: n // 4]
        a, e, x = sums_of(t), sums_of(edited), sums_of(nxt)
        out.append((i, n, hashlib.sha256(edited.encode()).hexdigest(), printed(a), printed(e), like(a[1], e[1]), like(a[1], x[1])))
    return Counter(out)


def random_text(rnd):
    pieces = ["One line.", "two  words", "Why? ", "So! ", "\n", "\n\n", " ", "\t", "é ü ß.", "日本 語", "...", "x", "\r\n", "\x0b", "😀!"]
    return "".join(rnd.choice(pieces) for _ in range(rnd.randint(0, 14)))


@pytest.mark.parametrize("seed", [1, 2])
def test_report_equals_plain_form(spark, tmp_path, seed):
    rnd = random.Random(seed)
    rows = [(i, random_text(rnd)) for i in range(0, 160, 2)]
    rows += [(1, None), (3, ""), (5, "word " * 20000 + "."), (7, "Line.\n" * 5000), (2, rows[1][1])]
    rows += [(None, "No id."), (None, "No id."), (9, " \n ")]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as _row_key", "2 as i", "'q' as `a.b`", "3 as n_chars")
    df.repartition(6).write.parquet(f"{tmp_path}/t")
    found = Counter(map(tuple, fp.fingerprint_report(spark.read.parquet(f"{tmp_path}/t")).collect()))
    rows.sort(key=lambda r: (r[0] is None, r[0]))
    assert found == plain(rows)


@pytest.mark.parametrize("rows", [[], [(4, "Alone. Here.\nand there")], [(1, None), (2, "")]])
def test_few_rows(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    assert Counter(map(tuple, fp.fingerprint_report(df).collect())) == (plain(rows) if rows else Counter())


def test_order_does_not_matter_and_edits_are_incremental(spark):
    a, b, c = "First paragraph.", "second, without an end", "Third! "
    texts = spark.createDataFrame([(f"{a}\n{b}\n{c}", f"{c}\n{a} {b}\n", f"{a}\n{c}", b)], "one string, two string, three string, gone string")
    units = texts.select(*[fp.paragraphs(F.col(x)).alias(x) for x in texts.columns])
    r = fp.with_sums(units, {f"s_{x}": x for x in texts.columns})
    row = r.select(
        fp.fingerprint(F.col("s_one")).alias("one"),
        fp.fingerprint(F.col("s_two")).alias("two"),
        fp.fingerprint(F.col("s_three")).alias("three"),
        fp.fingerprint(fp.deleted(F.col("s_one"), F.col("s_gone"))).alias("minus"),
        fp.fingerprint(fp.inserted(F.col("s_three"), F.col("s_gone"))).alias("plus"),
    ).first()
    assert row.one == row.two == row.plus != row.three == row.minus


def test_likeness_follows_shared_paragraphs(spark):
    rnd = random.Random(3)
    lines = ["".join(rnd.choice("abcdefgh ") for _ in range(30)) for _ in range(400)]
    rows = [(i, "\n".join(lines[:200])) for i in (1,)] + [(2, "\n".join(lines[100:300])), (3, "\n".join(lines[200:400])), (4, "\n".join(lines[:200]))]
    near = {r.doc_id: r.near_next for r in fp.fingerprint_report(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert abs(near[1] - 0.5) < 0.2 and abs(near[2] - 0.5) < 0.2 and near[3] < 0.3 and near[4] == 1.0


def test_native_plan(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], SCHEMA)
    plan = fp.fingerprint_report(df)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
