"""Exact dedup and the n-gram Jaccard join against brute force."""

from __future__ import annotations

import hashlib
import random
import re

import pytest

from talentflow.llm import exact_dedup as ed
from talentflow.llm import ngram_join as nj
from talentflow.llm.components import connected_components

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, count long, keep_id string"


def docs_of(spark, texts, first=0):
    return spark.createDataFrame([(first + i, t, None, "s", None, 7, "x") for i, t in enumerate(texts)], SCHEMA)


AWKWARD = [
    None, "", " \t\n", "a b", "ab", " ab", "ab ", "Ab", "\x0bab\x0c\r", "ä b", "äb", "word " * 30_000, "word " * 30_000 + " ",
    "x" * 300 + "1", "x" * 300 + "2", "x" * 300 + "1", " ab", "ab ",
]


def test_exact_dedup_matches_brute_force(spark):
    df = docs_of(spark, AWKWARD)
    norm = {i: re.sub(r"[\x20\x09-\x0D]", "", t or "") for i, t in enumerate(AWKWARD)}
    groups = {}
    for i, t in norm.items():
        groups.setdefault(t, []).append(i)
    want = {}
    for t, ids in groups.items():
        keep = min(ids, key=lambda i: (-len(AWKWARD[i] or ""), i))
        for i in ids:
            want[i] = (keep, len(ids), i == keep, hashlib.sha256(t.encode()).hexdigest())
    got = {r.doc_id: (r.keep_id, r.group_size, r.kept, r.text_sha256) for r in ed.dedup_report(df).collect()}
    assert got == want
    kept = ed.exact_dedup(df)
    assert kept.columns == df.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, v in want.items() if v[2]}


def test_the_report_goes_through_the_refinement(spark):
    """With a prefix of one character, only lengths and first characters settle
    rows before the whole texts do; the result is the same."""
    df = docs_of(spark, AWKWARD)
    want = sorted(map(tuple, ed.dedup_report(df).collect()))
    assert sorted(map(tuple, ed.dedup_report(df, prefix=1).collect())) == want
    settled = docs_of(spark, ["a", "bb", "cc", "dd d"])
    assert ed.duplicate_groups(settled).count() == 0
    assert [tuple(r)[:4] for r in ed.dedup_report(settled).orderBy("doc_id").collect()] == [(i, i, 1, True) for i in range(4)]


def test_exact_dedup_of_nothing(spark):
    df = docs_of(spark, ["a"]).limit(0)
    assert ed.dedup_report(df).count() == 0
    assert ed.exact_dedup(df).count() == 0


def sets_of(texts, k=5):
    out = []
    for t in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        out.append({tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set())
    return out


def brute_links(texts):
    s = sets_of(texts)
    links = {i: set() for i in range(len(s))}
    for i in range(len(s)):
        for j in range(i):
            if s[i] and s[j] and len(s[i] & s[j]) >= 0.8 * len(s[i] | s[j]):
                links[i].add(j)
                links[j].add(i)
    root = list(range(len(s)))
    for _ in s:
        root = [min([root[i], *(root[j] for j in links[i])]) for i in range(len(s))]
    return {i: len(v) for i, v in links.items()}, dict(enumerate(root))


def near_copies(seed=5):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)]
    texts = [None, "", "one two", "one two", "one  two", "one two three four five", "  "]
    for n in (40, 80, 200):
        base = [rng.choice(vocab) for _ in range(n)]
        for _ in range(25):
            w = list(base)
            for _ in range(rng.randrange(0, 1 + n // 25)):
                w[rng.randrange(n)] = rng.choice(vocab)
            texts.append(" ".join(w))
    texts += [" ".join(rng.choice(vocab) for _ in range(60)) for _ in range(40)]
    return texts + texts[10:14] + ["long " + " ".join(vocab) * 200]


@pytest.mark.parametrize("block", [256, 8])
def test_near_duplicates_match_all_pairs(spark, block):
    texts = near_copies()
    links, roots = brute_links(texts)
    rows = nj.near_duplicates(docs_of(spark, texts), block=block).collect()
    assert {r.doc_id: r.n_links for r in rows} == links
    assert {r.doc_id: r.class_id for r in rows} == roots
    assert len(rows) == len(texts)


def test_near_duplicates_on_documents(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = df.select("doc_id", "text").orderBy("doc_id").collect()
    links, roots = brute_links([r.text for r in rows])
    ids = [r.doc_id for r in rows]
    got = {r.doc_id: (r.class_id, r.n_links) for r in nj.near_duplicates(df).collect()}
    assert got == {ids[i]: (ids[roots[i]], links[i]) for i in links}
    kept = nj.drop_near_duplicates(df)
    assert kept.columns == df.columns
    assert {r.doc_id for r in kept.select("doc_id").collect()} == {ids[r] for r in roots.values()}


def test_near_duplicates_of_nothing(spark):
    df = docs_of(spark, ["a"]).limit(0)
    assert nj.near_duplicates(df).count() == 0
    assert sorted(nj.near_duplicates(docs_of(spark, [None, ""])).select("class_id", "n_links").collect()) == [(0, 0), (1, 0)]


def test_band_count_reaches_the_recall():
    for s, recall, r in ((0.8, 0.99999, 5), (0.8, 0.9, 8), (0.5, 0.999, 3)):
        b = nj.band_count(s, recall, r)
        assert 1 - (1 - s**r) ** b >= recall > 1 - (1 - s**r) ** (b - 1)


def test_components_of_chains_and_stars(spark):
    chain = [(i + 1, i) for i in range(40)]
    star = [(100, i) for i in range(101, 160)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(chain + star + [(7, 7)], "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 160)}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0
