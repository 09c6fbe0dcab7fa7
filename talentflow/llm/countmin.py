"""Substring dedup over word windows with a count-min prefilter.

Sketches.  Every partition of documents keeps a count-min sketch (``DEPTH``
rows of cells that saturate at two).  Partition sketches are cut into slices,
merged slice by slice in two steps, and only the "two or more" bits are kept.
Their size is bounded by ``MAX_CELLS`` whatever the input: a corpus beyond it
makes the filter less selective, never wrong.  Two are built: a coarse one of
the minimiser keys of super-windows (see :mod:`superwindows`; a window occurs
at most as often as its minimiser), then, among the windows that pass it, one
of the windows themselves.

Exact pass.  Only runs of windows estimated as repeated leave the scan, one
narrow row per run.  They are grouped exactly: equal runs first (a hot passage
collapses in the map-side aggregate), then the single windows of those
minimisers that have several different runs.  Runs are computed again from the
texts where they are needed twice, which is cheaper than storing them.

The words of removed windows then go back to their documents.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ROW, keyed_texts, shared
from .superwindows import SuperWindows, covered
from .tokens import U64, WORD_POWERS, Words, mix, range_hashes, text_blocks

WINDOW, GRAM = 20, 8
DEPTH = 2
SLICE_BITS = 20
MAX_CELLS = 1 << 28
# Bytes of text per super-window (about 6 a word, a new minimiser every 7
# words) and per word, and cells kept per super-window and per word.
BYTES_PER_KEY, CELLS_PER_KEY = 42, 4
BYTES_PER_WORD, CELLS_PER_WORD = 6, 2
FLUSH = 1 << 20
MERGE = 64


def sketch_bits(cells: int, max_cells: int = MAX_CELLS) -> int:
    """log2 of the cells of one row of a sketch, from the number wanted."""
    return min(int(math.log2(max_cells)), math.ceil(math.log2(max(1 << SLICE_BITS, cells))))


def _cells(keys: np.ndarray, bits: int, depth: int) -> np.ndarray:
    return mix(keys + U64((depth + 1) * 0x632BE59BD9B4E019 % (1 << 64))) >> U64(64 - bits)


def _pack(cells: np.ndarray) -> bytes:
    steps = np.diff(cells, prepend=cells.dtype.type(0)).astype(np.uint32)
    return zlib.compress(steps.view(np.uint8).reshape(-1, 4).T.tobytes(), 1)


def _unpack(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(data), np.uint8).reshape(4, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint32).ravel(), dtype=np.int64)


def _sketch_rows(keys: np.ndarray, bits: int, part: int) -> Iterator[tuple]:
    """Slices of one partition's sketch: cells seen once, cells seen more."""
    for depth in range(DEPTH):
        cells, n = np.unique(_cells(keys, bits, depth), return_counts=True)
        cuts = np.searchsorted(cells, np.arange(0, (1 << bits) + 1, 1 << SLICE_BITS).astype(U64))
        for s in np.flatnonzero(np.diff(cuts)):
            here, more = cells[cuts[s] : cuts[s + 1]] - U64(int(s) << SLICE_BITS), n[cuts[s] : cuts[s + 1]] > 1
            yield depth << 16 | int(s), part, _pack(here[~more]), _pack(here[more])


def _merge(table: pa.Table) -> pa.Table:
    count = np.zeros(1 << SLICE_BITS, np.uint8)
    for once, more in zip(table.column("once").to_pylist(), table.column("more").to_pylist()):
        for data, by in ((once, 1), (more, 2)):
            at = _unpack(data)
            count[at] = np.minimum(count[at] + by, 2)
    return pa.table(
        {
            "slice": table.column("slice")[:1],
            "part": table.column("part")[:1],
            "once": [_pack(np.flatnonzero(count == 1).astype(U64))],
            "more": [_pack(np.flatnonzero(count == 2).astype(U64))],
        }
    )


SKETCH = "slice int, part int, once binary, more binary"


def merged_sketch(df: DataFrame, keys_of: Callable[[pa.RecordBatch], Iterator[np.ndarray]], bits: int) -> DataFrame:
    """The merged sketch of the keys of all batches of ``df``: packed bits, one row per slice."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held, size = TaskContext.get().partitionId(), [], 0

        def out() -> pa.RecordBatch:
            rows = list(_sketch_rows(np.concatenate(held), bits, part))
            cols = [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.int32(), pa.binary(), pa.binary()))]
            return pa.RecordBatch.from_arrays(cols, names=["slice", "part", "once", "more"])

        for batch in batches:
            for keys in keys_of(batch):
                held.append(keys)
                size += len(keys)
                if size >= FLUSH:
                    yield out()
                    held, size = [], 0
        if size:
            yield out()

    slices = df.mapInArrow(build, SKETCH)
    # a tree: neighbouring partitions first, few sketches of a slice in one call
    for width in (MERGE, MERGE**2):
        slices = slices.groupBy("slice", F.floor(F.col("part") / width)).applyInArrow(lambda key, t: _merge(t), SKETCH)
    return slices.groupBy("slice").applyInArrow(_bitmap, "slice int, bits binary")


def _bitmap(table: pa.Table) -> pa.Table:
    """The "two or more" cells of a slice as packed bits: at most 128 KB."""
    merged = _merge(table)
    cells = np.zeros(1 << SLICE_BITS, bool)
    cells[_unpack(merged.column("more")[0].as_py())] = True
    return pa.table({"slice": merged.column("slice"), "bits": [zlib.compress(np.packbits(cells).tobytes(), 1)]})


def repeated_bits(sketch: DataFrame, bits: int) -> np.ndarray:
    """The bounded sketch as packed bits, one row per depth: at most
    ``DEPTH * MAX_CELLS / 8`` bytes, whatever the corpus."""
    out = np.zeros((DEPTH, 1 << bits >> 3), np.uint8)
    for r in sketch.collect():
        at = (r["slice"] & 0xFFFF) << (SLICE_BITS - 3)
        out[r["slice"] >> 16, at : at + (1 << SLICE_BITS - 3)] = np.frombuffer(zlib.decompress(r["bits"]), np.uint8)
    return out


def estimated_repeated(keys: np.ndarray, sketch: np.ndarray, bits: int) -> np.ndarray:
    keep = np.ones(len(keys), bool)
    for depth in range(DEPTH):
        cell = _cells(keys, bits, depth)
        keep &= (sketch[depth, (cell >> U64(3)).astype(np.int64)] >> (U64(7) - (cell & U64(7))).astype(np.uint8)) & 1 > 0
    return keep


class Filter:
    """A merged sketch, broadcast: may a key occur twice?"""

    def __init__(self, df: DataFrame, keys_of: Callable, bits: int):
        self.bits = bits
        sketch = merged_sketch(df, keys_of, bits)
        self.sketch = df.sparkSession.sparkContext.broadcast(repeated_bits(sketch, bits))

    def passes(self, keys: np.ndarray) -> np.ndarray:
        return estimated_repeated(keys, self.sketch.value, self.bits)


class Runs:
    """Runs of windows of one block that the filters pass, and their hashes."""

    def __init__(self, w: Words, window: int, gram: int, coarse: Filter, fine: Filter | None = None):
        s = SuperWindows(w.hashes, w.bounds, window, gram, WORD_POWERS)
        s.take(coarse.passes(s.key))
        at = np.repeat(s.first - np.cumsum(s.count) + s.count, s.count) + np.arange(s.count.sum())
        self.hashes = range_hashes(w.hashes, at, at + window, WORD_POWERS)
        if fine is not None and len(at):
            owner = np.repeat(np.arange(len(s.first)), s.count)
            keep = np.flatnonzero(fine.passes(self.hashes))
            at, owner, self.hashes = at[keep], owner[keep], self.hashes[keep]
            cut = np.flatnonzero(np.concatenate([[True], (owner[1:] != owner[:-1]) | (at[1:] != at[:-1] + 1)])[: len(at)])
            place = (s.first + s.offset)[owner[cut]]
            s.take(owner[cut])
            s.first, s.count = at[cut], np.diff(np.concatenate([cut, [len(at)]]))
            s.offset = place - s.first
        self.runs = s


def repeated_windows(docs: DataFrame, window: int, gram: int, max_cells: int = MAX_CELLS) -> DataFrame:
    """(row key, start, n): runs of windows whose words also start earlier.
    ``docs``: row key, doc_id, text."""
    total = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    text = docs.select("text")

    def minimisers(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        for _, data, offsets in text_blocks(batch.column(0)):
            w = Words(data, offsets)
            yield SuperWindows(w.hashes, w.bounds, window, gram, WORD_POWERS).key

    coarse = Filter(text, minimisers, sketch_bits(CELLS_PER_KEY * total // BYTES_PER_KEY, max_cells))

    def windows(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        for _, data, offsets in text_blocks(batch.column(0)):
            yield Runs(Words(data, offsets), window, gram, coarse).hashes

    fine = Filter(text, windows, sketch_bits(CELLS_PER_WORD * total // BYTES_PER_WORD, max_cells))
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def runs(only: Filter | None = None) -> DataFrame:
        """One row per run; with ``only`` just those of its keys, and hashes."""

        def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for row, data, offsets in text_blocks(batch.column(2)):
                    w = Words(data, offsets)
                    found = Runs(w, window, gram, coarse, fine)
                    s, hashes = found.runs, found.hashes
                    if only is not None and len(s.key):
                        keep = only.passes(s.key)
                        hashes = hashes[np.repeat(keep, s.count)]
                        s.take(keep)
                    cols = [
                        *(batch.column(c).slice(row).take(pa.array(s.row)) for c in (0, 1)),
                        pa.array(s.first - w.bounds[s.row], pa.int64()),
                        pa.array(s.count, pa.int32()),
                        pa.array(s.key.view(np.int64)),
                        pa.array(s.classes(w.hashes).view(np.int64)),
                        pa.array(s.offset, pa.int32()),
                    ]
                    names = [ROW, "doc_id", "start", "n", "key", "class", "offset"]
                    if only is not None:
                        ends = np.concatenate([[0], np.cumsum(s.count)]).astype(np.int32)
                        cols.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(hashes.view(np.int64))))
                        names.append("hashes")
                    yield pa.RecordBatch.from_arrays(cols, names=names)

        schema = f"{ROW} bigint, doc_id {id_type}, start bigint, n int, key bigint, class bigint, offset int"
        return docs.select(ROW, "doc_id", "text").mapInArrow(emit, schema + ", hashes array<bigint>" * (only is not None))

    def place(start: Column) -> Column:
        """Earlier places are smaller: by id (null ids last), row key, start."""
        return F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", ROW, start.alias("start"))

    here = place(F.col("start"))
    classes = shared(runs().groupBy("key", "class").agg(F.min(here).alias("place"), F.count("*").alias("copies")))
    # later occurrences of equal runs: all their windows start earlier
    later = (
        runs()
        .select(ROW, "doc_id", "start", "n", "key", "class")
        .join(classes.filter("copies > 1"), ["key", "class"])
        .filter(here > F.col("place"))
        .select(ROW, "start", F.col("n").cast("long").alias("n"))
    )
    # first occurrences: window by window, where a minimiser has several classes
    mixed = shared(classes.groupBy("key").count().filter("count > 1").select("key"))
    size = mixed.count()

    def twice(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        keys = np.asarray(batch.column(0)).view(U64)
        yield np.concatenate([keys, keys])

    some = runs(Filter(mixed, twice, sketch_bits(8 * size, max_cells)))
    single = (
        some.join(classes.join(mixed, "key", "left_semi").select("key", "class", "place"), ["key", "class"])
        .filter((F.col(ROW) == F.col(f"place.{ROW}")) & (F.col("start") == F.col("place.start")))
        .select("key", ROW, "doc_id", "start", "offset", F.posexplode("hashes").alias("i", "hash"))
        .select(
            "key",
            (F.col("offset") - F.col("i")).alias("offset"),
            "hash",
            place(F.col("start") + F.col("i")).alias("place"),
        )
    )
    single = shared(single)
    earliest = shared(
        single.groupBy("key", "offset", "hash").agg(F.min("place").alias("earliest"), F.count("*").alias("n")).filter("n > 1")
    )
    more = (
        single.join(earliest, ["key", "offset", "hash"])
        .filter("place > earliest")
        .select(f"place.{ROW}", "place.start", F.lit(1).cast("long").alias("n"))
    )
    return later.union(more)


def remove_repeats(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = WINDOW,
    gram: int = GRAM,
    max_cells: int = MAX_CELLS,
    texts: bool = True,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_removed, kept_sha256 and (with
    ``texts``) kept_text, its kept words joined by one space.

    Every word goes that lies in a window of ``window`` words whose words also
    start earlier (smaller id, null ids last; of rows with one id, the smaller row
    key; or the same row at a smaller position);
    windows are those of the input.  Null and empty texts have no words; a text
    shorter than a window keeps all.  Rows with a null or repeated id are
    documents of their own.  An empty table gives an empty result; other columns
    are ignored.
    """
    src = keyed_texts(docs, id_col, text_col)
    id_type = src.schema["doc_id"].dataType.simpleString()
    spans = repeated_windows(src, window, gram, max_cells).groupBy(ROW).agg(
        F.collect_list("start").alias("starts"), F.collect_list("n").alias("ns")
    )
    joined = src.join(spans, ROW, "left").select("doc_id", "text", "starts", "ns")
    schema = f"doc_id {id_type}, n_words bigint, n_removed bigint, kept_sha256 string" + ", kept_text string" * texts

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, data, offsets in text_blocks(batch.column(1)):
                w = Words(data, offsets)
                n_rows = len(offsets) - 1
                starts, ns = (batch.column(c).slice(row, n_rows) for c in (2, 3))
                size = np.asarray(starts.value_lengths().fill_null(0))
                base = np.repeat(w.bounds[:-1], size)
                lo = np.asarray(starts.flatten(), np.int64) + base
                gone = covered(len(w.hashes), lo, lo + np.asarray(ns.flatten(), np.int64) + window - 1)
                removed = np.diff(np.concatenate([[0], np.cumsum(gone)])[w.bounds])
                begin, end = w.starts[~gone], w.ends[~gone]
                inside = covered(len(data), begin, end)
                out = np.insert(data[inside], np.cumsum(end - begin), 0x20)  # each word, then a space
                cuts = np.concatenate([[0], np.cumsum(end - begin + 1)])[
                    np.concatenate([[0], np.cumsum(~gone)])[w.bounds]
                ]
                kept = [out[a : max(a, b - 1)].tobytes() for a, b in zip(cuts[:-1], cuts[1:])]
                cols = [
                    batch.column(0).slice(row, n_rows),
                    pa.array(np.diff(w.bounds), pa.int64()),
                    pa.array(removed, pa.int64()),
                    pa.array([hashlib.sha256(t).hexdigest() for t in kept]),
                ]
                if texts:
                    cols.append(pa.array(kept, pa.binary()).cast(pa.string()))
                names = ["doc_id", "n_words", "n_removed", "kept_sha256"] + ["kept_text"] * texts
                yield pa.RecordBatch.from_arrays(cols, names=names)

    return joined.mapInArrow(cut, schema)


ORACLE = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents
), win AS (
  SELECT doc_id, s, hash(words[s + 1 : s + 20]) AS h1, hash(list_reverse(words[s + 1 : s + 20])) AS h2
  FROM (SELECT doc_id, words, unnest(range(len(words) - 19)) AS s FROM w WHERE len(words) >= 20)
), rep AS (
  SELECT doc_id, s FROM (
    SELECT doc_id, s, row_number() OVER (PARTITION BY h1, h2 ORDER BY doc_id, s) AS r FROM win
  ) WHERE r > 1
), gone AS (
  SELECT DISTINCT doc_id, s + i AS p FROM rep, (SELECT unnest(range(20)) AS i)
), word AS (
  SELECT doc_id, unnest(words) AS word, unnest(range(len(words))) AS p FROM w
), kept AS (
  SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS t
  FROM word ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id
)
SELECT w.doc_id, len(words) AS n_words, len(words) - coalesce(n, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)
"""
