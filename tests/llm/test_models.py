"""Decontamination against plain edit distance; models by held-out accuracy."""

from __future__ import annotations

import itertools
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from talentflow.llm import decontaminate as dc
from talentflow.llm import language, quality, queries, toxicity
from tests.llm.test_copies import brute_links

SF = "/root/testdata/sf0.01"


def edit_best(item, text):
    """Smallest edit distance of the item to any substring of the text."""
    prev = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        cur = [i]
        for j, b in enumerate(text, 1):
            cur.append(min(prev[j] + 1, cur[-1] + 1, prev[j - 1] + (a != b)))
        prev = cur
    return min(prev)


def plain(t):
    return " ".join((t or "").lower().split())


def edited(rng, t, n):
    t = list(t)
    for _ in range(n):
        k, at = rng.randrange(3), rng.randrange(len(t))
        t[at : at + (k != 1)] = rng.choice("xyz") if k else ""
    return "".join(t)


def test_leaks_match_edit_distance(spark):
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("aeioulmnrst") for _ in range(rng.randrange(2, 9)))
    prose = lambda n: " ".join(word() for _ in range(n))
    items = [prose(n) for n in (4, 8, 15, 25, 40)] + ["tiny", "", None, "ÄÖÜ straße ünïcödé 漢字 " + prose(6)]
    texts = [None, "", "x", prose(3000) + " " + items[3], items[2].upper().replace(" ", "\n\t"), " ".join([items[1]] * 30)]
    for t in items[:5] + [items[8]]:
        for n in (0, 1, 3, 6, 12, 25):
            texts.append(f"{prose(rng.randrange(40))} {edited(rng, t, n)} {prose(rng.randrange(40))}")
    docs = spark.createDataFrame([(i, t, "e") for i, t in enumerate(texts)], "doc_id long, text string, item_id string")
    bench = spark.createDataFrame([(i, t, "e") for i, t in enumerate(items)], "item_id long, text string, doc_id string")
    want = {}
    for (d, t), (i, x) in itertools.product(enumerate(texts), enumerate(items)):
        x, t = plain(x), plain(t)
        e = dc.edit_budget(len(x), dc.EDIT_RATE, dc.GRAM)
        if e >= 0 and len(t) < 3000 and edit_best(x, t) <= e:
            want[d, i] = edit_best(x, t)
    for block in (dc.BLOCK_CHARS, 60):
        got = {(r.doc_id, r.item_id): r.distance for r in dc.leaked_pairs(docs, bench, block_chars=block).collect()}
        assert {k: v for k, v in got.items() if k[0] != 3} == want
        assert got[3, 3] == 0
    spans = dc.find_leaks(docs, bench).filter("distance = 0").collect()
    assert all(plain(texts[r.doc_id][r.start : r.end]) == plain(items[r.item_id]) for r in spans)
    assert sum(r.doc_id == 5 and r.item_id == 1 for r in spans) == 30
    kept = dc.drop_leaked(docs, bench)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == set(range(len(texts))) - {d for d, _ in got}
    assert dc.leaked_pairs(docs.limit(0), bench).count() == 0 and dc.leaked_pairs(docs, bench.limit(0)).count() == 0


def test_language_of_held_out_documents(spark):
    rows = queries.op4_language(spark, SF).collect()
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows) and len(rows) == len(truth)
    assert np.mean([truth[r.doc_id] == r.lang_pred for r in held]) > 0.98
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_edge_cases(spark):
    schema = "doc_id long, text string, lang string"
    train = spark.createDataFrame([(1, "the cat and the dog " * 20, "en"), (2, "der hund und die katze " * 20, "de")], schema)
    names = lambda rows: rows.select("doc_id", F.col("lang").alias("label"))
    model = language.fit(train, names(train))
    odd = spark.createDataFrame([(1, None, "x"), (1, "", None), (3, "123 !?", None), (4, "the dog " * 50_000, None), (5, "漢字", None)], schema)
    got = [(r.doc_id, r.lang_pred) for r in language.predict(odd, model).collect()]
    assert got[:4] == [(1, "und"), (1, "und"), (3, "und"), (4, "en")] and got[4][1] in ("en", "de")
    assert language.predict(odd.limit(0), model).count() == 0
    assert {r.lang_pred for r in language.predict(odd, language.fit(train, names(train.limit(0)))).collect()} == {"und"}


def test_filter_counts_equal_plain_sets():
    rng = random.Random(4)
    grams = np.array([rng.getrandbits(64) for _ in range(4000)], np.uint64)
    masks = np.array([rng.randrange(1, 8) for _ in grams])
    table: dict[int, int] = {}
    for place in language.places(grams):
        for p, m in zip(place.tolist(), masks.tolist()):
            table[p] = table.get(p, 0) | m
    f = language.Filter(["a", "b", "c"], np.array(list(table)), np.array(list(table.values())))
    got = np.full(len(grams), 255, np.uint8)
    for place in language.places(grams):
        got &= f.table[place]
    assert ((got & masks) == masks).all() and (got == masks).mean() > 0.99


def test_field_marginals_equal_enumeration():
    rng = np.random.default_rng(0)
    row = np.array([0, 0, 0, 0, 2, 3, 3])
    score, move = rng.normal(size=len(row)), rng.normal(size=(2, 2))
    marginal, moves, log_z = quality.forward_backward(score, move, quality.Chains(row))
    total = np.zeros((2, 2))
    for k, r in enumerate((0, 2, 3)):
        at = np.flatnonzero(row == r)
        weight = {}
        for y in itertools.product((0, 1), repeat=len(at)):
            weight[y] = np.exp(sum(score[a] * b for a, b in zip(at, y)) + sum(move[a, b] for a, b in zip(y, y[1:])))
        z = sum(weight.values())
        assert np.isclose(np.log(z), log_z[k])
        for i, a in enumerate(at):
            assert np.isclose(marginal[a], sum(w for y, w in weight.items() if y[i]) / z)
        for y, w in weight.items():
            for a, b in zip(y, y[1:]):
                total[a, b] += w / z
    assert np.allclose(moves, total)


@pytest.mark.parametrize("name, label, least", [("op5_quality", "quality", 0.95), ("op6_toxicity", "toxic", 0.9)])
def test_held_out_accuracy(spark, name, label, least):
    rows = queries.QUERIES[name](spark, "/root/testdata/sf0.1").collect()
    truth = {r.doc_id: r[label] for r in spark.read.parquet("/root/testdata/sf0.1/labels.parquet").collect()}
    held = [(r.predicted, truth[r.doc_id]) for r in rows if r.held_out and r.doc_id in truth]
    assert len(rows) == 10_000 and all(0 <= r.score <= 1 for r in rows)
    assert np.mean([p == t for p, t in held]) > least


def test_classifiers_on_edge_cases(spark):
    texts = [None, "", " \n\t\n", "one", "\n\nline one\n\n\nline two\n", "AB " * 100_000, "ok line. " * 5 + "\n" + "###&&& " * 30]
    odd = spark.createDataFrame([(i % 5, t, 0.5, 1) for i, t in enumerate(texts)], "doc_id long, text string, score double, predicted int")
    train = spark.createDataFrame(
        [(i, ("good line of words.\n" if i % 2 else "!!! ### $$$ bad idiot\n") * (1 + i % 4), i % 2) for i in range(40)] + [(99, None, 1)],
        "doc_id long, text string, label int",
    )
    for module in (quality, toxicity):
        for rows in (train, train.filter("label = 1"), train.limit(0)):
            model = module.fit(train, rows.select("doc_id", "label"))
            got = module.predict(odd, model).collect()
            assert len(got) == len(texts) and all(0 <= r.score <= 1 and r.predicted in (0, 1) for r in got)
        assert module.predict(odd.limit(0), model).count() == 0
    kept = quality.keep_good(odd, quality.fit(train, train.select("doc_id", "label")))
    assert kept.columns == odd.columns


def test_label_model_recovers_accurate_voters():
    rng = np.random.default_rng(6)
    y = rng.random(4000) < 0.15
    votes = np.stack([rng.random(4000) < np.where(y, 0.5, 0.01) for _ in range(8)] + [rng.random(4000) < 0.05], axis=1)
    votes = np.hstack([votes, votes[:, :1]]).astype(np.uint8)  # a copy of the first voter
    post, found = toxicity.label_model(votes, y.mean())
    assert ((post > 0.5) == y).mean() > 0.95
    assert found["weight"][0] < 0.75 * found["weight"][1]  # repeated evidence counts less


def test_pipeline_equals_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    model = quality.fit(docs, queries.training_labels(spark, sf, "quality"))
    good = {r.doc_id for r in quality.predict(docs, model).collect() if r.predicted}
    texts = {r.doc_id: r.text for r in docs.collect() if r.doc_id in good}
    groups: dict[str, list] = {}
    for i, t in sorted(texts.items()):
        groups.setdefault("".join(t.translate({c: None for c in (9, 10, 11, 12, 13, 32)})), []).append(i)
    left = sorted(min(g, key=lambda i: (-len(texts[i]), i)) for g in groups.values())
    _, roots = brute_links([texts[i] for i in left])
    left = [i for k, i in enumerate(left) if roots[k] == k]
    bench = [plain(r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, sf).collect()}
    gone = set(left) - set(got)
    assert set(got) <= set(left)
    leaked = lambda i: any(edit_best(x, plain(texts[i])) <= dc.edit_budget(len(x), dc.EDIT_RATE, dc.GRAM) for x in bench)
    assert all(leaked(i) for i in gone)
    assert not any(x in plain(texts[i]) for i in got for x in bench)
    from talentflow.llm import bpe

    enc = bpe.encoder(bpe.default_rank_file(), bpe.default_pattern())
    assert all(list(r.token_ids) == enc.encode_ordinary(texts[i]) for i, r in got.items())
    previous = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        previous = stage(spark, previous.limit(30), sf)
        assert previous.columns == docs.columns, name


def test_extra_columns_and_null_ids(spark):
    docs = spark.createDataFrame(
        [(None, "a b c d e f", 1, "k"), (1, "a b c d e f", 2, None), (2, None, 3, "z")], "doc_id long, text string, class_id int, bands string"
    )
    from talentflow.llm import bpe, exact_dedup, ngram_join, secrets

    for f in (ngram_join.near_duplicates, secrets.secret_report, bpe.encode_documents, exact_dedup.dedup_report):
        assert f(docs).count() == 3
    assert docs.select(F.count("*")).first()[0] == 3
