"""Benchmark decontamination by q-gram lemma filtering.

An item of m characters that occurs in a document with at most e edits shares
at least m - q + 1 - q*e of its q-grams with it, all on diagonals (document
position less item position) that differ by at most e.  Diagonals are counted
in units of e + 1; two neighbouring units form a band, so bands overlap and
every possible occurrence lies within one.  Bands that reach the bound are
verified by a banded alignment (unit costs, free ends in the document).

Case and runs of white space are ignored.  The benchmark is indexed in blocks
of at most ``BLOCK_CHARS`` characters: each block is a bounded broadcast, and
every block is held against all documents.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .chars import chunks, normalised, q_grams
from .common import ROW, drop_rows, free_name, text_of, with_row_key
from .tokens import U64

GRAM, EDIT_RATE = 8, 0.1
BLOCK_CHARS = 4_000_000
FILTER_BITS = 22
START_BITS = 32
DENSE_PAIRS = 1 << 22


def edit_budget(m: int, rate: float, q: int) -> int:
    """Edits allowed in an item of m characters: the rate's share, but few
    enough for the q-gram bound to ask for at least one q-gram; -1 for an
    item shorter than one q-gram, which nothing can match."""
    return min(int(rate * m), (m - q) // q) if m >= q else -1


class ItemIndex:
    """q-gram postings of one block of benchmark items."""

    def __init__(self, ids: list, texts: list[str], q: int, rate: float):
        self.ids, self.q = ids, q
        self.chars, _, self.bounds = normalised([t.strip() for t in texts])
        self.size = np.diff(self.bounds)
        self.budget = np.array([edit_budget(int(m), rate, q) for m in self.size], np.int64)
        self.least = np.maximum(self.size - q + 1 - q * self.budget, 1)
        grams, at = q_grams(self.chars, self.bounds, q)
        order = np.argsort(grams, kind="stable")
        at = at[order]
        self.item = (np.searchsorted(self.bounds, at, "right") - 1).astype(np.int64)
        self.offset = at - self.bounds[self.item]
        self.grams, self.first = np.unique(grams[order], return_index=True)
        self.count = np.diff(np.concatenate([self.first, [len(at)]]))
        self.filter = np.zeros(1 << FILTER_BITS, bool)
        self.filter[(self.grams >> U64(64 - FILTER_BITS)).astype(np.int64)] = True

    def candidates(self, chars: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(item, first diagonal of the band) of the bands that reach the bound."""
        grams, at = q_grams(chars, bounds, self.q)
        maybe = np.flatnonzero(self.filter[(grams >> U64(64 - FILTER_BITS)).astype(np.int64)])
        none = np.zeros(0, np.int64)
        if not len(maybe) or not len(self.grams):
            return none, none
        grams, at = grams[maybe], at[maybe]
        slot = np.minimum(np.searchsorted(self.grams, grams), len(self.grams) - 1)
        hit = self.grams[slot] == grams
        slot, at = slot[hit], at[hit]
        n = self.count[slot]
        post = np.repeat(self.first[slot] - np.cumsum(n) + n, n) + np.arange(n.sum())
        item, place = self.item[post], np.repeat(at, n)
        if not len(item):
            return none, none
        row = np.searchsorted(bounds, place, "right") - 1
        # items that share too few q-grams with a document have no band there
        owner = row * len(self.ids) + item
        if (len(bounds) - 1) * len(self.ids) <= DENSE_PAIRS:  # same counts, without a sort
            total = np.bincount(owner)[owner]
        else:
            _, back, n = np.unique(owner, return_inverse=True, return_counts=True)
            total = n[back]
        keep = total >= self.least[item]
        item, place, offset, row = item[keep], place[keep], self.offset[post][keep], row[keep]
        if not len(item):
            return none, none
        width = self.budget[item] + 1
        shift = int(self.size.max())  # diagonals may start before the document
        unit = (place - offset + shift) // width
        units = (len(chars) + 2 * shift) + 2
        owner = row * len(self.ids) + item
        band = np.concatenate([owner * units + unit, owner * units + unit - 1])
        gram = np.concatenate([offset, offset])
        both = _distinct(band, gram)
        bands, n = np.unique(both, return_counts=True)
        item = (bands // units) % len(self.ids)
        good = n >= self.least[item]
        bands, item = bands[good], item[good]
        return item, bands % units * (self.budget[item] + 1) - shift


def _distinct(band: np.ndarray, gram: np.ndarray) -> np.ndarray:
    """The band of every distinct (band, item position)."""
    order = np.lexsort((gram, band))
    band, gram = band[order], gram[order]
    new = np.concatenate([[True], (band[1:] != band[:-1]) | (gram[1:] != gram[:-1])])
    return band[new]


def align(items: ItemIndex, item: np.ndarray, diagonal: np.ndarray, row: np.ndarray, chars: np.ndarray, bounds: np.ndarray):
    """(distance, start, end) of the best alignment of each item within its
    band of 2(e+1) diagonals; many bands at once, one item character a step."""
    width = 2 * (items.budget[item] + 1)
    w, steps = int(width.max()), int(items.size[item].max())
    one = np.int64(1) << START_BITS
    cols = np.arange(w)
    outside = cols[None, :] >= width[:, None]
    far = one * (1 << 20)
    value = np.where(outside, far, diagonal[:, None] + cols + (1 << (START_BITS - 1)))
    lo, hi = bounds[row], bounds[row + 1]
    out = np.zeros(len(item), np.int64)
    column = np.zeros(len(item), np.int64)
    for i in range(steps):
        at = diagonal[:, None] + i + cols
        inside = (at >= lo[:, None]) & (at < hi[:, None])
        letter = items.chars[items.bounds[item] + np.minimum(i, items.size[item] - 1)]
        same = inside & (chars[np.clip(at, 0, len(chars) - 1)] == letter[:, None])
        step = value + np.where(same, 0, one)
        step[:, :-1] = np.minimum(step[:, :-1], value[:, 1:] + one)
        step[outside] = far
        step = np.minimum.accumulate(step - cols * one, axis=1) + cols * one
        step[outside] = far
        value = step
        done = np.flatnonzero(items.size[item] == i + 1)
        if len(done):
            best = value[done].argmin(axis=1)
            out[done], column[done] = value[done, best], best
    start = (out & (one - 1)) - (1 << (START_BITS - 1))
    end = diagonal + items.size[item] + column
    return out >> START_BITS, np.maximum(start, lo), np.minimum(end, hi)


def matches(items: ItemIndex, texts: list[str]) -> list[tuple[int, int, int, int, int]]:
    """(row, item, start, end, distance) in characters of the original text;
    of overlapping regions of one item the nearest, then leftmost."""
    chars, place, bounds = normalised(texts)
    item, diagonal = items.candidates(chars, bounds)
    found = []
    if not len(item):
        return found
    middle = np.clip(diagonal + items.budget[item] + 1 + items.size[item] // 2, 0, len(chars) - 1)
    row = np.searchsorted(bounds, middle, "right") - 1
    raw = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    for at in range(0, len(item), 512):
        s = slice(at, at + 512)
        dist, lo, hi = align(items, item[s], diagonal[s], row[s], chars, bounds)
        ok = np.flatnonzero((dist <= items.budget[item[s]]) & (hi > lo))
        for j in ok:
            r = int(row[s][j])
            found.append((r, int(item[s][j]), int(place[lo[j]] - raw[r]), int(place[hi[j] - 1] + 1 - raw[r]), int(dist[j])))
    kept: list[tuple] = []
    disjoint: dict[tuple[int, int], list[tuple[int, int]]] = {}
    for f in sorted(set(found), key=lambda f: (f[0], f[1], f[4], f[2])):
        spans = disjoint.setdefault(f[:2], [])
        k = bisect.bisect(spans, f[2:4])
        if not (k and spans[k - 1][1] > f[2]) and not (k < len(spans) and spans[k][0] < f[3]):
            spans.insert(k, f[2:4])
            kept.append(f)
    return kept


def benchmark_blocks(benchmark: DataFrame, id_col: str, text_col: str, block_chars: int) -> Iterator[tuple[list, list[str]]]:
    """The items in id order, in blocks of bounded size (or one longer item)."""
    ids, texts, size = [], [], 0
    rows = text_of(benchmark, id_col, text_col).orderBy("doc_id")
    for r in rows.toLocalIterator():
        if ids and size + len(r.text) > block_chars:
            yield ids, texts
            ids, texts, size = [], [], 0
        ids.append(r.doc_id)
        texts.append(r.text)
        size += len(r.text)
    if ids:
        yield ids, texts


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    q: int = GRAM,
    rate: float = EDIT_RATE,
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """(doc_id, item_id, start, end, distance): regions of documents within the
    edit budget of a benchmark item; positions in characters, end exclusive.

    Null and empty texts or items match nothing, nor do items of fewer than
    ``q`` characters.  Rows that repeat an id are searched each.  Empty tables
    give an empty result; other columns are ignored.
    """
    src = text_of(docs, id_col, text_col)
    id_type = src.schema["doc_id"].dataType.simpleString()
    item_type = benchmark.schema[item_col].dataType.simpleString()
    schema = f"doc_id {id_type}, item_id {item_type}, start bigint, end bigint, distance int"
    spark = docs.sparkSession

    def search(block):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            items = ItemIndex(*block.value, q, rate)
            item_ids = pa.array(items.ids)
            for batch in batches:
                texts = batch.column(1).to_pylist()
                for at, part in chunks(texts):
                    found = matches(items, part)
                    if found:
                        row, item, lo, hi, dist = (list(c) for c in zip(*found))
                        yield pa.RecordBatch.from_arrays(
                            [
                                batch.column(0).take(pa.array([at + r for r in row])),
                                item_ids.take(pa.array(item)),
                                pa.array(lo, pa.int64()),
                                pa.array(hi, pa.int64()),
                                pa.array(dist, pa.int32()),
                            ],
                            names=["doc_id", "item_id", "start", "end", "distance"],
                        )

        return src.mapInArrow(run, schema)

    out = None
    for ids, texts in benchmark_blocks(benchmark, item_col, item_text_col, block_chars):
        part = search(spark.sparkContext.broadcast((ids, texts)))
        out = part if out is None else out.union(part)
    return spark.createDataFrame([], schema) if out is None else out


def leaked_pairs(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """One row per document and item: doc_id, item_id, n_regions, and start,
    end, distance of the nearest (then leftmost) region."""
    best = F.min(F.struct("distance", "start", "end")).alias("best")
    return (
        find_leaks(docs, benchmark, **options)
        .groupBy("doc_id", "item_id")
        .agg(F.count("*").alias("n_regions"), best)
        .select("doc_id", "item_id", "n_regions", "best.start", "best.end", "best.distance")
    )


def drop_leaked(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """The documents without any region near a benchmark item, decided by row:
    ids may be null or repeated."""
    key = free_name(docs, ROW)
    rows = with_row_key(docs, key)
    leaked = find_leaks(rows, benchmark, id_col=key, **options).select(F.col("doc_id").alias(ROW)).distinct()
    return drop_rows(rows, leaked, docs.columns, key)
