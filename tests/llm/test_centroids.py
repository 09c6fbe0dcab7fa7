"""Vector-approximation clustering against a plain loop in Python's integers."""

from __future__ import annotations

import hashlib
import math
import random
from collections import Counter

import pytest

from talentflow.llm.centroids import cluster_vectors

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows, k=16, rounds=3, dims=64, scale=64):
    kept = [
        (i, [math.floor(scale * x) for x in e])
        for i, e in rows
        if e is not None and len(e) == dims and all(x is not None and math.isfinite(x) for x in e)
    ]
    order = sorted(kept, key=lambda r: (hashlib.sha256(f"1:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    c = [v for _, v in order[:k]]

    def dist(a, b):
        return sum((x - y) ** 2 for x, y in zip(a, b))

    def near(v):
        return min(range(len(c)), key=lambda j: (dist(v, c[j]), j))

    for _ in range(rounds):
        of = [near(v) for _, v in kept]
        for j in range(len(c)):
            mine = [v for (_, v), a in zip(kept, of) if a == j]
            if mine:
                c[j] = [sum(col) // len(mine) for col in zip(*mine)]
    of = [near(v) for _, v in kept]
    d = [dist(v, c[a]) for (_, v), a in zip(kept, of)]
    per = Counter()
    for a, x in zip(of, d):
        per[a] += x
    digest = [hashlib.sha256(",".join(map(str, v)).encode()).hexdigest() for v in c]
    return Counter((i, a, x, per[a], sum(d), digest[a]) for (i, _), a, x in zip(kept, of, d))


def f32(x):
    import numpy as np

    return float(np.float32(x))


@pytest.mark.parametrize("bits,wide", [(1, 1.0), (2, 0.3), (4, 1.0), (6, 40.0)])
def test_equals_plain_loop(spark, bits, wide):
    rnd = random.Random(bits)
    middles = [[rnd.gauss(0, wide) for _ in range(64)] for _ in range(5)]
    rows = [(i, [f32(m + rnd.gauss(0, wide / 2)) for m in rnd.choice(middles)]) for i in range(150)]
    rows += [(1000 + i, rows[3][1]) for i in range(40)]  # one very common vector
    df = spark.createDataFrame([(i, e, 0) for i, e in rows], SCHEMA).repartition(4)
    assert Counter(map(tuple, cluster_vectors(df, bits=bits).collect())) == plain(rows)


def test_odd_rows(spark):
    rnd = random.Random(5)
    good = [(i, [f32(rnd.uniform(-1, 1)) for _ in range(64)]) for i in range(30)]
    odd = [
        (100, None),
        (101, []),
        (102, [0.5] * 63),
        (103, [0.5] * 65),
        (104, [0.5] * 63 + [None]),
        (105, [0.5] * 63 + [float("nan")]),
        (106, [float("inf")] + [0.5] * 63),
        (None, [0.25] * 64),
        (None, [0.25] * 64),
        (7, good[0][1]),
        (7, good[1][1]),
        (107, [-0.0] * 64),
    ]
    rows = good + odd
    df = spark.createDataFrame([(i, e, 0) for i, e in rows], SCHEMA)
    clashing = df.selectExpr("*", "1 as v", "2 as _row_key", "3 as cluster", "4 as `a.b`")
    want = plain(rows)
    assert Counter(map(tuple, cluster_vectors(clashing).collect())) == want
    assert Counter(map(tuple, cluster_vectors(df.filter("vec_id < 4")).collect())) == plain([r for r in rows if r[0] is not None and r[0] < 4])


@pytest.mark.parametrize("where", ["false", "vec_id = 100"])
def test_no_vectors(spark, where):
    df = spark.createDataFrame([(100, None, 0)], SCHEMA).filter(where)
    out = cluster_vectors(df)
    assert out.count() == 0
    assert out.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def test_components_that_do_not_fit_raise(spark):
    df = spark.createDataFrame([(1, [1e30] * 64, 0)], SCHEMA)
    with pytest.raises(Exception, match="would not fit"):
        cluster_vectors(df).collect()
