"""Centroid clustering (Lloyd rounds) over a vector-approximation file.

1. one scan turns vectors into integer components and stores them with a row
   key; a second takes range, mean and spread of every dimension;
2. the approximation table holds one cell number per dimension (``bits`` bits):
   most cells divide the bulk of the dimension evenly, the two outer ones reach
   to its ends;
3. a lookup table gives each cell's bounds, and these an interval of every
   centroid's distance.  A vector whose best interval overlaps no other is
   assigned by its cells alone;
4. after the first round, sums change only where vectors change cluster.  A
   round reads the approximation table, and fetches full vectors only where
   intervals overlap or the cluster changes.  Only sums per cluster leave it.

What is on the driver, or goes to every task, is ``k`` centroids and the cell
bounds; neither grows with the table.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import ROW, number_rows, shared

K, ROUNDS, DIMS, SCALE, BITS = 16, 3, 64, 64, 6
SPREAD = 2.5  # the inner cells cover so many standard deviations on each side
EXACT = 1 << 53
# Squared distances of components up to this size fit a long.
LIMIT = 1 << 27


def dot(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact product of integer matrices, in floating point where that is exact."""
    if int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0)) * max(1, a.shape[1]) < EXACT:
        return (a.astype(np.float64) @ b.astype(np.float64)).astype(np.int64)
    return a @ b


class Cells:
    """Cell borders of every dimension, and the lookup tables of cell bounds."""

    def __init__(self, low: np.ndarray, high: np.ndarray, mean: np.ndarray, spread: np.ndarray, bits: int):
        at = np.linspace(-SPREAD, SPREAD, (1 << bits) - 1)
        borders = np.floor(mean[:, None] + spread[:, None] * at[None, :]).astype(np.int64)
        self.borders = np.clip(borders, low[:, None], high[:, None] + 1)
        self.lower = np.concatenate([low[:, None], self.borders], axis=1)
        self.upper = np.concatenate([self.borders - 1, high[:, None]], axis=1)

    def encode(self, v: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(b, v[:, j], "right") for j, b in enumerate(self.borders)], axis=1).astype(np.uint8)

    def candidates(self, codes: np.ndarray, centroids: np.ndarray) -> np.ndarray:
        """Which centroids may be nearest: those whose interval of distances
        reaches below the end of the lowest interval.  Intervals leave out the
        vector's own norm, which is the same for all centroids."""
        dims = np.arange(codes.shape[1])
        low, high = self.lower[dims, codes], self.upper[dims, codes]
        plus, minus = np.maximum(centroids, 0).T, np.minimum(centroids, 0).T
        norm = (centroids * centroids).sum(axis=1)
        least = norm - 2 * (dot(high, plus) + dot(low, minus))
        most = norm - 2 * (dot(low, plus) + dot(high, minus))
        return least <= most.min(axis=1)[:, None]


def settled(may: np.ndarray) -> np.ndarray:
    """The only candidate of each row, -1 where there are several."""
    return np.where(may.sum(axis=1) == 1, may.argmax(axis=1), -1)


def distances(v: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    return (v * v).sum(axis=1)[:, None] - 2 * dot(v, centroids.T) + (centroids * centroids).sum(axis=1)


def nearest(v: np.ndarray, centroids: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Clusters, taken from ``known`` but where that is -1; ties go to the
    smaller number."""
    out, at = known.copy(), np.flatnonzero(known < 0)
    if len(at):
        out[at] = distances(v[at], centroids).argmin(axis=1)
    return out


def components(lists: pa.Array, dims: int) -> np.ndarray:
    return np.asarray(lists.flatten(), np.int64).reshape(-1, dims)


def integer_vectors(vectors: DataFrame, id_col: str, vec_col: str, dims: int, scale: int) -> DataFrame:
    """(row key, vec_id, v) of the vectors that count, stored as Parquet."""
    spark = vectors.sparkSession
    src = vectors.select(F.col(f"`{id_col}`").alias("vec_id"), F.col(f"`{vec_col}`").cast("array<double>").alias("e"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pc.fill_null(pc.equal(pc.list_value_length(batch.column(1)), dims), False))
            flat = batch.column(1).flatten()
            x = np.asarray(pc.fill_null(flat, np.nan), np.float64).reshape(-1, dims)
            whole = np.isfinite(x).all(axis=1)
            with np.errstate(over="ignore"):
                v = np.floor(x[whole] * scale)
            if (np.abs(v) > LIMIT).any():
                raise ValueError(f"a component beyond {LIMIT // scale}: squared distances would not fit a long")
            v = v.astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).filter(pa.array(whole)), pa.ListArray.from_arrays(np.arange(0, v.size + 1, dims, np.int32), v.ravel())],
                names=["vec_id", "v"],
            )

    id_type = src.schema["vec_id"].dataType.simpleString()
    path = scratch_path(spark, f"vectors-{uuid.uuid4().hex}")
    number_rows(src.mapInArrow(run, f"vec_id {id_type}, v array<int>")).write.parquet(path)
    return spark.read.parquet(path)


def first_centroids(rows: DataFrame, k: int, seed: str) -> np.ndarray:
    """The ``k`` vectors with the smallest hash of seed and id; equal hashes by
    their components.  A null id is hashed as an empty one."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    return np.array([r.v for r in rows.select(digest.alias("h"), "v").orderBy("h", "v").limit(k).collect()], np.int64)


def fit_cells(rows: DataFrame, dims: int, bits: int) -> Cells:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, low, high, total, square = 0, None, None, 0.0, 0.0
        for batch in batches:
            v = components(batch.column(0), dims)
            if not len(v):
                continue
            low = v.min(axis=0) if low is None else np.minimum(low, v.min(axis=0))
            high = v.max(axis=0) if high is None else np.maximum(high, v.max(axis=0))
            n, total, square = n + len(v), total + v.sum(axis=0), square + (v.astype(np.float64) ** 2).sum(axis=0)
        if n:
            columns = [np.arange(dims), np.full(dims, n), low, high, np.float64(total), np.float64(square)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["dim", "n", "low", "high", "total", "square"])

    parts = rows.select("v").mapInArrow(run, "dim bigint, n bigint, low bigint, high bigint, total double, square double")
    stats = (
        parts.groupBy("dim")
        .agg(F.min("low"), F.max("high"), F.sum("total") / F.sum("n"), F.sum("square") / F.sum("n"))
        .orderBy("dim")
        .toArrow()
    )
    low, high, mean, square = (np.asarray(stats.column(i)) for i in range(1, 5))
    return Cells(low, high, mean, np.sqrt(np.maximum(square - mean**2, 0)), bits)


class Sums:
    """Vectors and component sums per cluster, in Python's integers."""

    def __init__(self, k: int, dims: int):
        self.n, self.total = [0] * k, [[0] * dims for _ in range(k)]

    def add(self, parts: DataFrame) -> None:
        """``parts``: cluster, dim (-1: the number of vectors), x; one row per
        task, cluster and dimension, added up in Spark."""
        for r in parts.groupBy("cluster", "dim").agg(F.sum(F.col("x").cast("decimal(38,0)")).alias("x")).collect():
            if r.dim < 0:
                self.n[r.cluster] += int(r.x)
            else:
                self.total[r.cluster][r.dim] += int(r.x)

    def centroids(self, before: np.ndarray) -> np.ndarray:
        return np.array([[x // n for x in total] if n else old for n, total, old in zip(self.n, self.total, before.tolist())], np.int64)


class TaskSums:
    SCHEMA = "cluster int, dim int, x bigint"

    def __init__(self, k: int, dims: int):
        self.n, self.total = np.zeros(k, np.int64), np.zeros((k, dims), np.int64)

    def add(self, cluster: np.ndarray, v: np.ndarray, sign: int = 1) -> None:
        np.add.at(self.total, cluster, sign * v)
        self.n += sign * np.bincount(cluster, minlength=len(self.n))

    def batch(self) -> pa.RecordBatch:
        k, dims = self.total.shape
        x = np.concatenate([self.n[:, None], self.total], axis=1)
        cluster, dim = np.repeat(np.arange(k), dims + 1), np.tile(np.arange(-1, dims), k)
        some = np.flatnonzero(x.ravel())
        return pa.RecordBatch.from_arrays(
            [pa.array(cluster[some], pa.int32()), pa.array(dim[some], pa.int32()), pa.array(x.ravel()[some])], names=["cluster", "dim", "x"]
        )


def approximate(rows: DataFrame, cells: Cells, dims: int) -> DataFrame:
    """The approximation table (row key, code), one byte per dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = cells.encode(components(batch.column(1), dims))
            binary = pa.FixedSizeBinaryArray.from_buffers(pa.binary(dims), len(codes), [None, pa.py_buffer(codes.tobytes())])
            yield pa.RecordBatch.from_arrays([batch.column(0), binary.cast(pa.binary())], names=[ROW, "code"])

    path = scratch_path(rows.sparkSession, f"cells-{uuid.uuid4().hex}")
    rows.select(ROW, "v").mapInArrow(run, f"{ROW} bigint, code binary").write.parquet(path)
    return rows.sparkSession.read.parquet(path)


def first_sums(rows: DataFrame, cells: Cells, centroids: np.ndarray) -> DataFrame:
    k, dims = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = TaskSums(k, dims)
        for batch in batches:
            v = components(batch.column(0), dims)
            sums.add(nearest(v, centroids, settled(cells.candidates(cells.encode(v), centroids))), v)
        yield sums.batch()

    return rows.select("v").mapInArrow(run, TaskSums.SCHEMA)


def moved_sums(rows: DataFrame, approximations: DataFrame, cells: Cells, old: np.ndarray, new: np.ndarray) -> DataFrame:
    """How the sums change when the centroids go from ``old`` to ``new``."""
    k, dims = new.shape

    def open_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint8).reshape(-1, dims)
            before, after = (settled(cells.candidates(codes, c)) for c in (old, new))
            at = np.flatnonzero((before < 0) | (before != after))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(at)), pa.array(before[at], pa.int32()), pa.array(after[at], pa.int32())],
                names=[ROW, "before", "after"],
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = TaskSums(k, dims)
        for batch in batches:
            v = components(batch.column(0), dims)
            before, after = (nearest(v, c, np.asarray(batch.column(i), np.int64)) for i, c in ((1, old), (2, new)))
            at = np.flatnonzero(before != after)
            sums.add(before[at], v[at], -1)
            sums.add(after[at], v[at])
        yield sums.batch()

    wanted = shared(approximations.select(ROW, "code").mapInArrow(open_rows, f"{ROW} bigint, before int, after int"))
    return rows.select(ROW, "v").join(wanted, ROW).select("v", "before", "after").mapInArrow(run, TaskSums.SCHEMA)


def assign(rows: DataFrame, cells: Cells, centroids: np.ndarray) -> DataFrame:
    """(vec_id, cluster, distance) of every row."""
    dims = centroids.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = components(batch.column(1), dims)
            cluster = nearest(v, centroids, settled(cells.candidates(cells.encode(v), centroids)))
            d = ((v - centroids[cluster]) ** 2).sum(axis=1)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(cluster, pa.int32()), pa.array(d)], names=["vec_id", "cluster", "distance"]
            )

    id_type = rows.schema["vec_id"].dataType.simpleString()
    return rows.select("vec_id", "v").mapInArrow(run, f"vec_id {id_type}, cluster int, distance bigint")


RESULT = "cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid_sha256 string"


def cluster_vectors(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    k: int = K,
    rounds: int = ROUNDS,
    dims: int = DIMS,
    scale: int = SCALE,
    bits: int = BITS,
    seed: str = "1",
) -> DataFrame:
    """One row per vector that counts: vec_id, cluster, distance (squared, to
    the final centroid), cluster_inertia and inertia (distances summed over the
    cluster and over all), centroid_sha256.

    A vector counts if it has exactly ``dims`` components, none null or not
    finite; its components become floor(scale * x).  Others have no row.  Null
    and repeated ids are rows like others.  Of fewer than ``k`` vectors each is
    a first centroid; an empty table, or one without such vectors, gives an
    empty result.  Equal centroids: the smaller number gets the vectors, the
    other stays as it is.  Other columns are ignored.  Components beyond
    ``LIMIT`` / ``scale`` raise, as squared distances would not fit a long.
    """
    spark = vectors.sparkSession
    rows = integer_vectors(vectors, id_col, vec_col, dims, scale)
    centroids = first_centroids(rows, k, seed)
    if not len(centroids):
        return spark.createDataFrame([], f"vec_id {rows.schema['vec_id'].dataType.simpleString()}, {RESULT}")
    cells = fit_cells(rows, dims, bits)
    approximations = approximate(rows, cells, dims) if rounds > 1 else None
    sums, old = Sums(len(centroids), dims), None
    for _ in range(rounds):
        if old is None:
            sums.add(first_sums(rows, cells, centroids))
        elif (old != centroids).any():
            sums.add(moved_sums(rows, approximations, cells, old, centroids))
        old, centroids = centroids, sums.centroids(centroids)
    found = shared(assign(rows, cells, centroids))
    inertia = {r.cluster: int(r.d) for r in found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("d")).collect()}
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    clusters = [(c, d, sum(inertia.values()), digests[c]) for c, d in inertia.items()]
    table = spark.createDataFrame(clusters, "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    return found.join(F.broadcast(table), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )


def _round(n: int) -> str:
    """SQL: assignment to the centroids c{n}, and the centroids after it."""
    return f"""
a{n} AS (
  SELECT p.rid, p.vec_id, p.v, arg_min(c.cluster, (list_sum(list_transform(list_zip(p.v, c.v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))), c.cluster)) AS cluster
  FROM p CROSS JOIN c{n} c GROUP BY p.rid, p.vec_id, p.v
), s{n} AS (
  SELECT cluster, j, sum(v[j])::HUGEINT AS s, count(*)::HUGEINT AS n FROM a{n}, range(1, {DIMS + 1}) t(j) GROUP BY cluster, j
), c{n + 1} AS (
  SELECT c.cluster, coalesce(m.v, c.v) AS v
  FROM c{n} c LEFT JOIN (SELECT cluster, list(((s - (s % n + n) % n) // n)::BIGINT ORDER BY j) AS v FROM s{n} GROUP BY cluster) m USING (cluster)
)"""


ORACLE = f"""
WITH p AS (
  SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE len(embedding) = {DIMS} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {DIMS}
), c0 AS (
  SELECT (row_number() OVER (ORDER BY sha256('1:' || vec_id), v) - 1)::INTEGER AS cluster, v
  FROM p ORDER BY cluster LIMIT {K}
),{",".join(_round(n) for n in range(ROUNDS))},{_round(ROUNDS)}, r AS (
  SELECT a.vec_id, a.cluster, list_sum(list_transform(list_zip(a.v, c.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS distance,
         sha256(array_to_string(c.v, ',')) AS centroid_sha256
  FROM a{ROUNDS} a JOIN c{ROUNDS} c USING (cluster)
)
SELECT vec_id, cluster, distance, (sum(distance) OVER (PARTITION BY cluster))::BIGINT AS cluster_inertia,
       (sum(distance) OVER ())::BIGINT AS inertia, centroid_sha256
FROM r
"""
