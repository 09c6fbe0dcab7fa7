"""Substring dedup on bytes with suffix arrays.

Documents are cut into super-windows (see :mod:`superwindows`): all equal
windows of ``window`` bytes have the same minimiser key, so a shard that holds
every super-window of a key can decide them without other shards.

1. One scan emits a narrow row per super-window.  A key that occurs once is
   settled.  Of the others, equal super-windows collapse to one class (map-side
   first); a class of two or more is repeated throughout.
2. Of the other keys one representative text per class goes to a shard.
   Shards are bounded: their number follows from the bytes to sort, and a key
   with more than ``hot_bytes`` is dealt over several shards.
3. A shard sorts its suffixes by Larsson-Sadakane refinement (prefix doubling
   on the groups that are still unsorted), takes common prefixes by Kasai's
   walk, and marks windows with a neighbour of at least ``window`` bytes in common.
4. The sorted window keys of shards that share a hot key are merged: the key
   space is cut into ranges, and within a range every shard's run is looked up by
   binary search in all the others.
5. The covered ranges go back to their documents.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ROW, keyed_texts, shared
from .superwindows import SuperWindows, covered
from .tokens import BYTE_POWERS, BYTE_VALUES, U64, Powers, mix, range_hashes, text_blocks

WINDOW, GRAM = 400, 64
SHARD_BYTES = 1 << 21
HOT_BYTES = 1 << 18
RANGE_WINDOWS = 1 << 20
SEPARATOR = 0xFF  # never a byte of UTF-8
LANE = 64
WINDOW_POWERS = Powers(0x94D049BB133111EB)


# ------------------------------------------------------ one shard, numpy --

def words_of(text: np.ndarray) -> np.ndarray:
    """The eight bytes from every position, first byte most significant."""
    padded = np.concatenate([text, np.full(8, SEPARATOR, np.uint8)])
    out = np.zeros(len(text), U64)
    for i in range(8):
        out = (out << U64(8)) | padded[i : i + len(text)]
    return out


def suffix_array(text: np.ndarray) -> np.ndarray:
    """The suffixes in order; past the end of the text counts as the largest.

    Larsson-Sadakane refinement: suffixes sorted by h bytes are grouped; within
    each unsorted group the rank of the suffix h bytes further on sorts by 2h
    bytes.  A group's rank is the position of its last member, so ranks stay
    valid while other groups are refined, and sorted groups are never touched
    again.
    """
    n = len(text)
    first = words_of(text)
    order = np.argsort(first, kind="stable")
    if n < 2:
        return order
    sorted_words = first[order]
    last = np.flatnonzero(np.concatenate([sorted_words[1:] != sorted_words[:-1], [True]]))
    rank = np.empty(n, np.int64)
    rank[order] = np.repeat(last, np.diff(last, prepend=-1))
    h = 8
    size = np.diff(last, prepend=-1)
    open_groups = np.flatnonzero(size > 1)
    slots = np.repeat(last[open_groups] - size[open_groups] + 1, size[open_groups]) + _within(size[open_groups])
    while len(slots):
        at = order[slots]
        group = rank[at]
        beyond = at + h
        key = np.where(beyond < n, rank[np.minimum(beyond, n - 1)], n)
        by = np.lexsort((key, group))
        at, group, key = at[by], group[by], key[by]
        order[slots] = at  # groups keep their slots, which ascend with their ranks
        ends = np.flatnonzero(np.concatenate([(group[1:] != group[:-1]) | (key[1:] != key[:-1]), [True]]))
        size = np.diff(ends, prepend=-1)
        rank[at] = np.repeat(slots[ends], size)
        slots = slots[np.repeat(size > 1, size)]
        h *= 2
    return order


def _within(sizes: np.ndarray) -> np.ndarray:
    """0..size-1 for each size, concatenated."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - sizes, sizes)


def common_prefixes(text: np.ndarray, order: np.ndarray, limit: int) -> np.ndarray:
    """For every text position the bytes its suffix shares with the previous
    suffix in order, reported up to ``limit``: Kasai's walk, in which the value
    at a position is at least the one before it less one.  The walk runs side
    by side in lanes of ``LANE`` consecutive positions."""
    n = len(text)
    previous = np.full(n, -1, np.int64)
    previous[order[1:]] = order[:-1]
    eight = words_of(text)
    out = np.zeros(n, np.int32)
    lanes = np.arange(0, n, LANE)
    length = np.zeros(len(lanes), np.int64)
    for step in range(LANE):
        at = lanes + step
        live = np.flatnonzero(at < n)
        length = np.maximum(length - 1, 0)
        length[previous[np.minimum(at, n - 1)] < 0] = 0
        live = live[previous[at[live]] >= 0]
        while len(live):
            a, b = at[live], previous[at[live]]
            diff = eight[np.minimum(a + length[live], n - 1)] ^ eight[np.minimum(b + length[live], n - 1)]
            same = np.where(diff == 0, 8, _leading_zero_bytes(diff))
            room = n - np.maximum(a, b) - length[live]  # a suffix ends with the text
            length[live] += np.minimum(same, np.maximum(room, 0))
            live = live[(same == 8) & (room > 8)]
        here = at < n
        out[at[here]] = np.minimum(length[here], limit)
    return out


def _leading_zero_bytes(x: np.ndarray) -> np.ndarray:
    return sum((x >> U64(64 - 8 * i) == 0).astype(np.int64) for i in range(1, 8))


def repeated_in_shard(parts: list[np.ndarray], window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(owner part, start in part, class) of every window of the parts; windows
    have equal bytes exactly when they have equal classes."""
    sizes = np.array([len(p) + 1 for p in parts])
    begin = np.cumsum(sizes) - sizes
    text = np.full(sizes.sum(), SEPARATOR, np.uint8)
    for b, p in zip(begin, parts):
        text[b : b + len(p)] = p
    order = suffix_array(text)
    lcp = common_prefixes(text, order, window)
    run = np.cumsum(lcp[order] < window) - 1
    klass = np.empty(len(text), np.int64)
    klass[order] = run
    n = np.maximum(sizes - window, 0)
    owner = np.repeat(np.arange(len(parts)), n)
    start = _within(n)
    return owner, start, klass[begin[owner] + start]


# ------------------------------------------------------------ Spark jobs --

def super_windows(docs: DataFrame, window: int, gram: int) -> DataFrame:
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, data, offsets in text_blocks(batch.column(1)):
                values = BYTE_VALUES[data]
                s = SuperWindows(values, offsets, window, gram, BYTE_POWERS)
                if not len(s.key):
                    continue
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(row).take(pa.array(s.row)),
                        pa.array(s.first - offsets[s.row], pa.int64()),
                        pa.array(s.count, pa.int32()),
                        pa.array(s.key.view(np.int64)),
                        pa.array(s.classes(values).view(np.int64)),
                    ],
                    names=["doc_id", "start", "n", "key", "class"],
                )

    return docs.select("doc_id", "text").mapInArrow(emit, f"doc_id {id_type}, start bigint, n int, key bigint, class bigint")


def _segments(docs: DataFrame, places: DataFrame, window: int) -> DataFrame:
    """(doc_id, start, key, shard, hot, bytes) of the given super-windows."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    lists = places.groupBy("doc_id").agg(F.collect_list(F.struct("start", "n", "key", "shard", "hot", "single")).alias("parts"))
    joined = docs.join(lists, "doc_id").select("doc_id", "text", "parts")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                size = part.column(2).value_lengths()
                inner = part.column(2).flatten()
                owner = np.repeat(np.arange(part.num_rows), np.asarray(size))
                texts = [(t or "").encode() for t in part.column(1).to_pylist()]
                starts, ns = np.asarray(inner.field("start")), np.asarray(inner.field("n"))
                data = [texts[o][s : s + n + window - 1] for o, s, n in zip(owner, starts, ns)]
                cols = [part.column(0).take(pa.array(owner))]
                cols += [inner.field(c) for c in ("start", "key", "shard", "hot", "single")]
                yield pa.RecordBatch.from_arrays(
                    [*cols, pa.array(data, pa.binary())], names=["doc_id", "start", "key", "shard", "hot", "single", "bytes"]
                )

    return joined.mapInArrow(
        cut, f"doc_id {id_type}, start bigint, key bigint, shard int, hot boolean, single boolean, bytes binary"
    )


def _runs(starts: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(owner, start, n) of maximal runs of consecutive starts."""
    if not len(starts):
        return owner, starts, starts
    cut = np.flatnonzero(np.concatenate([[True], (owner[1:] != owner[:-1]) | (starts[1:] != starts[:-1] + 1)]))
    return owner[cut], starts[cut], np.diff(np.concatenate([cut, [len(starts)]]))


def sort_shard(table: pa.Table, window: int, ranges: int) -> pa.Table:
    """Rows of two kinds: repeated runs (doc_id, start, n), and for hot keys
    the sorted window keys per range (keys, places) for the merge."""
    parts = [np.frombuffer(b, np.uint8) for b in table.column("bytes").to_pylist()]
    ids = table.column("doc_id").combine_chunks()
    base = np.asarray(table.column("start"))
    hot, single = (np.asarray(table.column(c).combine_chunks().cast(pa.int8())).astype(bool) for c in ("hot", "single"))
    owner, start, klass = repeated_in_shard(parts, window)
    size = np.bincount(klass) if len(klass) else np.zeros(0, np.int64)
    again = (size[klass] > 1) & single[owner]
    own, first, n = _runs(start[again], owner[again])
    out = [_rows(ids, own, base[own] + first, n)]
    left = np.flatnonzero(hot[owner])
    if len(left):
        text = np.concatenate([BYTE_VALUES[p] for p in parts])
        begin = np.cumsum([len(p) for p in parts]) - np.array([len(p) for p in parts])
        at = begin[owner[left]] + start[left]
        keys = mix(range_hashes(text, at, at + window, WINDOW_POWERS) ^ np.asarray(table.column("key")).view(U64)[owner[left]])
        sort = np.argsort(keys, kind="stable")
        left, keys = left[sort], keys[sort]
        lot = (keys >> U64(32)) * U64(ranges) >> U64(32)
        for r in np.unique(lot):
            a, b = np.searchsorted(lot, [r, r + U64(1)])
            here = left[a:b]
            done = ~single[owner[here]] | again[here]  # known as repeated: only to be found by others
            out.append(
                _rows(ids, owner[here][:1], base[owner[here][:1]], np.zeros(1, np.int64)).drop_columns(["range", "keys", "docs", "starts", "open"])
                .append_column("range", pa.array([int(r)], pa.int32()))
                .append_column("keys", pa.array([keys[a:b].view(np.int64)], pa.list_(pa.int64())))
                .append_column("docs", pa.array([ids.take(pa.array(owner[here])).to_pylist()], pa.list_(ids.type)))
                .append_column("starts", pa.array([base[owner[here]] + start[here]], pa.list_(pa.int64())))
                .append_column("open", pa.array([~done], pa.list_(pa.bool_())))
            )
    return pa.concat_tables(out)


def _rows(ids: pa.Array, own: np.ndarray, start: np.ndarray, n: np.ndarray) -> pa.Table:
    k = len(own)
    return pa.table(
        {
            "doc_id": ids.take(pa.array(own, pa.int64())),
            "start": pa.array(start, pa.int64()),
            "n": pa.array(n, pa.int64()),
            "range": pa.nulls(k, pa.int32()),
            "keys": pa.nulls(k, pa.list_(pa.int64())),
            "docs": pa.nulls(k, pa.list_(ids.type)),
            "starts": pa.nulls(k, pa.list_(pa.int64())),
            "open": pa.nulls(k, pa.list_(pa.bool_())),
        }
    )


def merge_range(table: pa.Table) -> pa.Table:
    """Windows of one key range that another shard has too: each shard's sorted
    run is looked up by binary search in every run."""
    keys = [np.array(k, np.int64).view(U64) for k in table.column("keys").to_pylist()]
    every = np.sort(np.concatenate(keys), kind="stable")  # runs are sorted: a merge
    docs, starts = [], []
    for k, d, s, o in zip(keys, *(table.column(c).to_pylist() for c in ("docs", "starts", "open"))):
        found = np.searchsorted(every, k, "right") - np.searchsorted(every, k, "left")
        own = np.searchsorted(k, k, "right") - np.searchsorted(k, k, "left")
        hit = np.flatnonzero((found > own) & np.array(o, bool))
        docs += [d[i] for i in hit]
        starts += [s[i] for i in hit]
    return pa.table({"doc_id": pa.array(docs, table.column("docs").type.value_type), "start": pa.array(starts, pa.int64())})


def repeated_spans(
    docs: DataFrame,
    window: int = WINDOW,
    gram: int = GRAM,
    shard_bytes: int = SHARD_BYTES,
    hot_bytes: int = HOT_BYTES,
) -> DataFrame:
    """(doc_id, start, n): runs of windows that start anywhere else as well.
    ``docs``: doc_id (unique, not null), text."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    every = shared(super_windows(docs, window, gram))
    # Keys that occur once are settled; only the others go on.
    repeated = shared(every.groupBy("key").count().filter("count > 1").select("key"))
    rows = shared(every.join(repeated, "key", "left_semi"))
    classes = shared(
        rows.groupBy("key", "class").agg(
            F.count("*").alias("copies"), F.min(F.struct("doc_id", "start", "n")).alias("place")
        )
    )
    copied = (
        rows.join(shared(classes.filter("copies > 1").select("key", "class")), ["key", "class"], "left_semi")
        .select("doc_id", "start", F.col("n").cast("long").alias("n"))
    )
    mixed = shared(
        classes.groupBy("key")
        .agg(F.count("*").alias("classes"), F.sum(F.col("place.n") + F.lit(window - 1)).alias("bytes"))
        .filter("classes > 1")
    )
    total = mixed.agg(F.coalesce(F.sum("bytes"), F.lit(0)), F.coalesce(F.sum(F.expr(f"if(bytes > {hot_bytes}, bytes, 0)")), F.lit(0))).first()
    shards = max(1, -(-total[0] // shard_bytes))
    ranges = max(1, -(-total[1] // RANGE_WINDOWS))
    hot = F.col("bytes") > hot_bytes
    places = classes.join(mixed, "key").select(
        "place.doc_id",
        "place.start",
        "place.n",
        "key",
        (F.col("copies") == 1).alias("single"),
        F.pmod(F.when(hot, F.xxhash64("key", "class")).otherwise(F.xxhash64("key")), F.lit(shards)).cast("int").alias("shard"),
        hot.alias("hot"),
    )
    sorted_shards = shared(
        _segments(docs, places, window)
        .groupBy("shard")
        .applyInArrow(
            lambda t: sort_shard(t, window, ranges),
            f"doc_id {id_type}, start bigint, n bigint, range int, keys array<bigint>, docs array<{id_type}>, starts array<bigint>, open array<boolean>",
        )
    )
    within = sorted_shards.filter("range is null").select("doc_id", "start", "n")
    across = (
        sorted_shards.filter("range is not null")
        .groupBy("range")
        .applyInArrow(merge_range, f"doc_id {id_type}, start bigint")
        .select("doc_id", "start", F.lit(1).cast("long").alias("n"))
    )
    return copied.union(within).union(across)


def remove_repeats(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = WINDOW,
    texts: bool = True,
    **options,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_removed, n_spans, kept_sha256 and
    (with ``texts``) kept, the remaining bytes.

    Every byte goes that lies in a string of ``window`` bytes which also starts
    anywhere else, in the same document or another, overlaps included, judged
    on the input.  Null texts are empty; a text shorter than the window keeps
    all.  Rows are told apart by a row key: rows with a null or repeated id
    are documents of their own.  An empty table gives an empty result; other
    columns are ignored.
    """
    src = keyed_texts(docs, id_col, text_col)
    id_type = src.schema["doc_id"].dataType.simpleString()
    found = repeated_spans(src.select(F.col(ROW).alias("doc_id"), "text"), window, **options)
    spans = found.groupBy(F.col("doc_id").alias(ROW)).agg(F.collect_list("start").alias("starts"), F.collect_list("n").alias("ns"))
    joined = src.join(spans, ROW, "left").select("doc_id", "text", "starts", "ns")
    schema = f"doc_id {id_type}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string" + ", kept binary" * texts

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, data, offsets in text_blocks(batch.column(1)):
                n_rows = len(offsets) - 1
                starts, ns = (batch.column(c).slice(row, n_rows) for c in (2, 3))
                base = np.repeat(offsets[:-1], np.asarray(starts.value_lengths().fill_null(0)))
                lo = np.asarray(starts.flatten(), np.int64) + base
                gone = covered(len(data), lo, lo + np.asarray(ns.flatten(), np.int64) + window - 1)
                begins = gone & ~np.concatenate([[False], gone[:-1]]) if len(gone) else gone
                begins[offsets[:-1][offsets[:-1] < len(data)]] |= gone[offsets[:-1][offsets[:-1] < len(data)]]
                count = lambda mask: np.diff(np.concatenate([[0], np.cumsum(mask)])[offsets])
                kept = [data[a:b][~gone[a:b]].tobytes() for a, b in zip(offsets[:-1], offsets[1:])]
                cols = [
                    batch.column(0).slice(row, n_rows),
                    pa.array(np.diff(offsets), pa.int64()),
                    pa.array(count(gone), pa.int64()),
                    pa.array(count(begins), pa.int64()),
                    pa.array([hashlib.sha256(t).hexdigest() for t in kept]),
                ]
                names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"] + ["kept"] * texts
                yield pa.RecordBatch.from_arrays(cols + [pa.array(kept, pa.binary())] * texts, names=names)

    return joined.mapInArrow(cut, schema)
