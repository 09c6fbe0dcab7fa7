"""Suffix-array and count-min substring dedup against brute force."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

from talentflow.llm import countmin, suffix_array as sa
from talentflow.llm.superwindows import leftmost_minimum

SCHEMA = "doc_id long, text string, key string, start int, n string"


def docs_of(spark, texts):
    return spark.createDataFrame([(i, t, None, 1, "x") for i, t in enumerate(texts)], SCHEMA)


def passages(seed=3, vocab=300):
    rng = random.Random(seed)
    words = [f"{rng.choice('abcdefgh')}{i}é" for i in range(vocab)]
    some = lambda n: " ".join(rng.choice(words) for _ in range(n))
    passage, other = some(90), some(130)
    texts = [None, "", "   ", "short text", "same " * 400, "same " * 300, "ab " * 300 + some(50)]
    for _ in range(12):
        texts.append(f"{some(rng.randrange(60))} {passage} {some(rng.randrange(60))}")
    texts += [f"{some(20)}\n{other}\t{some(30)} {other} {passage}", other, passage[:380], passage, passage]
    whole = some(300)
    texts += [whole, whole, whole + " tail", "head " + whole, some(20_000) + whole]
    return texts + [some(rng.randrange(200)) for _ in range(10)]


def brute_bytes(texts, k):
    data = {i: (t or "").encode() for i, t in enumerate(texts)}
    seen = Counter(t[i : i + k] for t in data.values() for i in range(len(t) - k + 1))
    out = {}
    for d, t in data.items():
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - k + 1):
            if seen[t[i : i + k]] > 1:
                gone[i : i + k] = True
        spans = int((gone & ~np.concatenate([[False], gone[:-1]])).sum()) if len(t) else 0
        kept = bytes(c for c, g in zip(t, gone) if not g)
        out[d] = (len(t), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize("options", [{}, {"window": 120, "gram": 16, "hot_bytes": 1500, "shard_bytes": 4000}])
def test_suffix_array_dedup_matches_brute_force(spark, options):
    texts = passages()
    rows = sa.remove_repeats(docs_of(spark, texts), **options).collect()
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows}
    assert got == brute_bytes(texts, options.get("window", sa.WINDOW))
    assert all(hashlib.sha256(r.kept).hexdigest() == r.kept_sha256 for r in rows)


def test_suffix_array_dedup_on_documents(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = df.select("doc_id", "text").orderBy("doc_id").collect()
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in sa.remove_repeats(df, texts=False).collect()}
    want = brute_bytes([r.text for r in rows], 400)
    assert got == {rows[i].doc_id: v for i, v in want.items()}


def test_suffixes_are_sorted_and_prefixes_right():
    rng = np.random.default_rng(8)
    for n, letters in ((1, 2), (2, 1), (70, 1), (90, 2), (700, 2), (900, 5)):
        t = rng.integers(97, 97 + letters, n).astype(np.uint8)
        t = np.concatenate([t, t[: n // 2]])
        order, text = sa.suffix_array(t), t.tobytes()
        full = [text[i:] + b"\xff" for i in order]
        assert full == sorted(full) and sorted(order) == list(range(len(t)))
        lcp = sa.common_prefixes(t, order, 40)
        for a, b in zip(order, order[1:]):
            k = 0
            while k < 40 and max(a, b) + k < len(t) and t[a + k] == t[b + k]:
                k += 1
            assert lcp[b] == k


def brute_words(texts, k=20):
    words = {i: re.findall(r"[^\x20\x09-\x0D]+", t or "") for i, t in enumerate(texts)}
    seen, out = set(), {}
    for d, w in words.items():
        gone = set()
        for i in range(len(w) - k + 1):
            window = tuple(w[i : i + k])
            if window in seen:
                gone.update(range(i, i + k))
            seen.add(window)
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out[d] = (len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest())
    return out


@pytest.mark.parametrize("cells", [countmin.MAX_CELLS, 1 << countmin.SLICE_BITS])
def test_countmin_dedup_matches_brute_force(spark, cells):
    texts = passages(seed=4)
    rows = countmin.remove_repeats(docs_of(spark, texts), max_cells=cells).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in rows} == brute_words(texts)
    assert all(hashlib.sha256(r.kept_text.encode()).hexdigest() == r.kept_sha256 for r in rows)


def test_sketch_never_underestimates():
    rng = np.random.default_rng(2)
    keys = rng.integers(0, 1 << 63, 30_000).astype(np.uint64)
    keys = np.concatenate([keys, keys[:5000]])
    import pyarrow as pa

    bits, sketch = countmin.SLICE_BITS, np.zeros((countmin.DEPTH, 1 << countmin.SLICE_BITS >> 3), np.uint8)
    parts = [row for p, half in enumerate(np.array_split(keys, 3)) for row in countmin._sketch_rows(half, bits, p)]
    for depth in range(countmin.DEPTH):
        cols = list(zip(*[r for r in parts if r[0] >> 16 == depth]))
        merged = countmin._merge(pa.table(dict(zip(("slice", "part", "once", "more"), cols))))
        count = np.zeros(1 << bits, bool)
        count[countmin._unpack(merged.column("more")[0].as_py())] = True
        sketch[depth] = np.packbits(count)
    estimated = countmin.estimated_repeated(keys, sketch, bits)
    assert estimated[:5000].all() and estimated[-5000:].all()
    assert estimated[5000:30_000].mean() < 0.05
    assert countmin.sketch_bits(0) == countmin.SLICE_BITS and countmin.sketch_bits(10**15) == 28 and countmin.sketch_bits(1 << 24) == 24


def test_leftmost_minimum():
    rng = np.random.default_rng(1)
    for n, w in ((5, 5), (40, 7), (300, 33)):
        v = rng.integers(0, 6, n).astype(np.uint64) << np.uint64(40)
        assert leftmost_minimum(v, w).tolist() == [i + int(np.argmin(v[i : i + w])) for i in range(n - w + 1)]


def test_nothing_and_null_ids(spark):
    empty = docs_of(spark, ["a"]).limit(0)
    assert sa.remove_repeats(empty).count() == 0 and countmin.remove_repeats(empty).count() == 0
    odd = spark.createDataFrame([(None, "word " * 500), (None, "word " * 500), (1, None), (1, "b")], "doc_id long, text string")
    assert sa.remove_repeats(odd).count() == 4 and countmin.remove_repeats(odd).count() == 4
