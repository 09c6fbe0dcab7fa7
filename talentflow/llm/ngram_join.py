"""Near-duplicate join: Jaccard similarity of word n-gram sets.

1. one scan turns each text into a key of its word sequence and MinHash band
   hashes; equal word sequences collapse to one representative with a count;
2. a shuffle on (band, hash) counts every bucket and finds its smallest member,
   the hub; a document is linked to the smallest of its hubs, and its other hubs
   to that one (never members to each other).  The components of those links
   are the candidate clusters;
3. the full n-gram sets of cluster members are shipped once to their cluster
   and all its pairs are verified there.  A cluster of more than ``block``
   members is split: every pair of blocks is its own task of bounded size.
   Tasks give back one row per document (number of links, local root), never
   pairs.

Band and row counts follow from the similarity and the target recall.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ROW, drop_rows, first_row, free_name, keyed_texts, named, shared, with_row_key
from .components import connected_components
from .tokens import BLOCK_BYTES, U64, Words, WORD_POWERS, mix, range_hashes, text_blocks

WORDS, SIMILARITY, RECALL, ROWS = 5, 0.8, 0.99999, 5
BLOCK = 256
STEP = 4096


def band_count(similarity: float, recall: float, rows: int) -> int:
    """The smallest number of bands that finds a pair of this similarity with
    at least this probability: 1 - (1 - s**r)**b >= recall."""
    return max(1, math.ceil(math.log(1 - recall) / math.log(1 - similarity**rows)))


def _signature(shingles: np.ndarray, factors: np.ndarray, shifts: np.ndarray) -> np.ndarray:
    low = (shingles >> U64(32)).astype(np.uint32)
    out = np.full(len(factors), 0xFFFFFFFF, np.uint32)
    for at in range(0, len(low), STEP):
        np.minimum(out, (low[None, at : at + STEP] * factors[:, None] + shifts[:, None]).min(axis=1), out=out)
    return out


def signatures(docs: DataFrame, words: int, bands: int, rows: int) -> DataFrame:
    """(doc_id, key, bands, ...) of ``docs`` (doc_id, text, ...): two 64-bit hashes
    of the word sequence, and the band hashes; both null for a text without
    words."""
    seeds = mix(np.arange(1, 2 * bands * rows + 1, dtype=U64) * U64(0xA24BAED4963EE407))
    factors = (seeds[: bands * rows] >> U64(32)).astype(np.uint32) | np.uint32(1)
    shifts = (seeds[bands * rows :] >> U64(32)).astype(np.uint32)
    salts = mix(np.arange(1, bands + 1, dtype=U64))
    id_type, rest = docs.schema["doc_id"].dataType.simpleString(), docs.schema.fields[2:]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, data, offsets in text_blocks(batch.column(1)):
                w = Words(data, offsets)
                keys, sigs = [], []
                lo, hi = w.bounds[:-1], w.bounds[1:]
                one = range_hashes(w.hashes, lo, hi, WORD_POWERS).view(np.int64)
                two = range_hashes(mix(w.hashes + U64(1)), lo, hi, WORD_POWERS).view(np.int64)
                for r, s in enumerate(w.shingles(words)):
                    if not len(s):
                        keys.append(None)
                        sigs.append(None)
                        continue
                    keys.append(f"{hi[r] - lo[r]}:{one[r]:x}:{two[r]:x}")
                    sig = _signature(s, factors, shifts).reshape(bands, rows).astype(U64)
                    h = salts.copy()
                    for c in range(rows):
                        h = mix(h * U64(0x9E3779B97F4A7C15) + sig[:, c])
                    sigs.append(h.view(np.int64))
                own = batch.slice(row, len(offsets) - 1).columns
                yield pa.RecordBatch.from_arrays(
                    [own[0], pa.array(keys, pa.string()), pa.array(sigs, pa.list_(pa.int64())), *own[2:]],
                    names=["doc_id", "key", "bands", *(f.name for f in rest)],
                )

    schema = [f"doc_id {id_type}", "key string", "bands array<bigint>", *(f"{f.name} {f.dataType.simpleString()}" for f in rest)]
    return docs.mapInArrow(run, ", ".join(schema))


def shingle_sets(docs: DataFrame, words: int) -> DataFrame:
    """(doc_id, text, ...) with the text replaced by its set of n-gram hashes."""
    rest = [c for c in docs.columns if c != "text"]
    schema = ", ".join([f"{c} {docs.schema[c].dataType.simpleString()}" for c in rest] + ["shingles array<bigint>"])
    src = docs.select("text", *rest)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, data, offsets in text_blocks(batch.column(0), BLOCK_BYTES):
                sets = [s.view(np.int64) for s in Words(data, offsets).shingles(words)]
                part = batch.slice(row, len(sets))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[1:], pa.array(sets, pa.list_(pa.int64()))], names=[*rest, "shingles"]
                )

    return src.mapInArrow(run, schema)


def shared_counts(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Matrix of intersection sizes of the sets values[bounds[i]:bounds[i+1]]."""
    n = len(bounds) - 1
    owner = np.repeat(np.arange(n), np.diff(bounds))
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    new = np.concatenate([[True], values[1:] != values[:-1]]) if len(values) else np.zeros(0, bool)
    column = np.cumsum(new) - 1
    size = np.bincount(column) if len(column) else np.zeros(0, np.int64)
    keep = size[column] > 1 if len(column) else np.zeros(0, bool)  # values of one set only add nothing
    owner, column = owner[keep], (np.cumsum(size > 1) - 1)[column[keep]]
    out = np.zeros((n, n), np.float64)
    for at in range(0, int(column[-1]) + 1 if len(column) else 0, STEP):
        lo, hi = np.searchsorted(column, [at, at + STEP])
        m = np.zeros((n, STEP), np.float32)
        m[owner[lo:hi], column[lo:hi] - at] = 1
        out += m @ m.T
    return out


def verify(table: pa.Table, similarity: float) -> pa.Table:
    """The links within one task: all pairs of one block, or all pairs between
    two blocks; one row per document with a link."""
    table = table.sort_by("doc_id").combine_chunks()
    lists = table.column("shingles").combine_chunks()
    values, bounds = np.asarray(lists.flatten()), np.concatenate([[0], np.cumsum(np.diff(np.asarray(lists.offsets)))])
    sizes = np.diff(bounds)
    inter = shared_counts(values, bounds)
    union = sizes[:, None] + sizes[None, :] - inter
    link = (inter >= similarity * union - 1e-9) & (sizes[:, None] > 0)
    np.fill_diagonal(link, False)
    first, second = table.column("first")[0].as_py(), table.column("second")[0].as_py()
    if first != second:
        block = np.asarray(table.column("block"))
        link &= block[:, None] != block[None, :]
    root = np.arange(len(sizes))
    while True:  # labels settle within a block
        near = np.where(link, root[None, :], len(root)).min(axis=1, initial=len(root))
        new = np.minimum(root, near)
        new = new[new]
        if (new == root).all():
            break
        root = new
    n = link @ np.asarray(table.column("copies")).astype(np.int64)
    keep = np.flatnonzero(link.any(axis=1))
    ids = table.column("doc_id").combine_chunks()
    return pa.table(
        {
            "doc_id": ids.take(pa.array(keep)),
            "root": ids.take(pa.array(root[keep])),
            "n_links": pa.array(n[keep], pa.int64()),
            "split": table.column("split").combine_chunks().take(pa.array(keep)),
        }
    )


def bucket_links(member: DataFrame) -> DataFrame:
    """(a, b) links that connect all members (doc_id, bucket) of every bucket."""
    # Stored, so that the join back has a plain exchange on each side and
    # adaptive execution can split a hot bucket (likewise a hot cluster below).
    hubs = shared(member.groupBy("bucket").agg(F.min("doc_id").alias("hub"), F.count("*").alias("n")).filter("n > 1"))
    met = member.join(hubs.select("bucket", "hub"), "bucket")
    stars = shared(met.groupBy("doc_id").agg(F.min("hub").alias("least"), F.collect_set("hub").alias("hubs")))  # a hub per band at most
    others = stars.select(F.explode("hubs").alias("a"), F.col("least").alias("b")).filter("a <> b").distinct()
    return stars.select(F.col("doc_id").alias("a"), F.col("least").alias("b")).union(others)


def classes(src: DataFrame, words: int, similarity: float, recall: float, rows: int, block: int) -> DataFrame:
    """(doc_id, id, class_id, copy_of, n_links) of ``src`` (doc_id, text, id)
    with unique doc_id: the smallest of a document's class and of its copies;
    ``id`` is handed on."""
    id_type = src.schema["doc_id"].dataType.simpleString()
    sigs = shared(signatures(src, words, band_count(similarity, recall, rows), rows))
    reps = (
        sigs.filter("key is not null")
        .groupBy("key")
        .agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("copies"), F.first("bands").alias("bands"))
    )
    clusters = connected_components(bucket_links(reps.select("doc_id", F.explode("bands").alias("bucket"))))
    sizes = shared(clusters.groupBy("component").agg(F.ceil(F.count("*") / F.lit(block)).cast("int").alias("blocks")))
    candidates = (
        clusters.join(sizes, "component")
        .select(
            F.col("node").alias("doc_id"),
            F.col("component").alias("cluster"),
            "blocks",
            F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int").alias("block"),
        )
        .join(reps.select("doc_id", "copies"), "doc_id")
    )
    sets = shingle_sets(src.select("doc_id", "text").join(candidates, "doc_id"), words)
    tasks = sets.withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)"))).select(
        "doc_id",
        "cluster",
        "copies",
        "block",
        F.least("block", "other").alias("first"),
        F.greatest("block", "other").alias("second"),
        (F.col("blocks") > 1).alias("split"),
        "shingles",
    )
    found = shared(
        tasks.groupBy("cluster", "first", "second").applyInArrow(
            lambda t: verify(t, similarity), f"doc_id {id_type}, root {id_type}, n_links bigint, split boolean"
        )
    )
    whole = found.filter("not split").select("doc_id", F.col("root").alias("class_id"))
    parts = connected_components(found.filter("split").select(F.col("doc_id").alias("a"), F.col("root").alias("b")))
    grouped = whole.union(parts.select("node", "component"))
    counts = found.groupBy("doc_id").agg(F.sum("n_links").alias("n_links"))
    linked = reps.select("key", "doc_id", "copies").join(grouped, "doc_id", "left").join(counts, "doc_id", "left").select(
        "key",
        F.col("doc_id").alias("copy_of"),
        F.coalesce("class_id", "doc_id").alias("class_id"),
        (F.coalesce("n_links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
    )
    return sigs.select("doc_id", "id", "key").join(linked, "key", "left").select(
        "doc_id",
        "id",
        F.coalesce("class_id", "doc_id").alias("class_id"),
        F.coalesce("copy_of", "doc_id").alias("copy_of"),
        F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
    )


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = WORDS,
    similarity: float = SIMILARITY,
    recall: float = RECALL,
    rows: int = ROWS,
    block: int = BLOCK,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, class_id (the smallest id of its
    group of near-duplicates, transitively closed), copy_of (the smallest id
    among documents of the same words), n_links (other rows whose n-gram set
    has at least the similarity, copies included).

    A text of 1 to ``words - 1`` words has one n-gram, all its words.  A null,
    empty or blank text is its own class without links.  Words are compared
    unchanged.  Rows are told apart by a row key, never by their id: rows with a
    null or repeated id are documents of their own; class_id and copy_of are
    null if no row of the group has an id.  An empty table gives an empty
    result; other columns are ignored.
    """
    keyed = keyed_texts(docs, id_col, text_col)
    found = classes(
        keyed.select(F.col(ROW).alias("doc_id"), "text", F.col("doc_id").alias("id")), words, similarity, recall, rows, block
    )
    members = shared(
        found.select(F.col("id").alias("doc_id"), F.col("class_id").alias("class"), F.col("copy_of").alias("copy"), "n_links")
    )
    linked = members.filter("n_links > 0")
    first_of = shared(linked.groupBy("class").agg(F.min("doc_id").alias("class_id")))
    copy_of = shared(linked.groupBy("copy").agg(F.min("doc_id").alias("copy_of")))
    alone = F.col("n_links") == 0
    return members.join(first_of, "class", "left").join(copy_of, "copy", "left").select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.when(alone, F.col("doc_id")).otherwise(F.col("copy_of")).alias("copy_of"),
        "n_links",
    )


def drop_near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = WORDS,
    similarity: float = SIMILARITY,
    recall: float = RECALL,
    rows: int = ROWS,
    block: int = BLOCK,
) -> DataFrame:
    """The documents that stay, with all their columns: of each group the one
    with the smallest id (null ids last), then the smallest row key.  Groups
    are formed over row keys, as ids may be null or repeated."""
    key = free_name(docs, ROW)
    keyed = with_row_key(docs, key)
    texts = keyed.select(F.col(key).alias("doc_id"), F.coalesce(named(text_col), F.lit("")).alias("text"), named(id_col).alias("id"))
    found = classes(texts, words, similarity, recall, rows, block).filter("n_links > 0")
    members = shared(found.select(F.col("doc_id").alias(ROW), F.col("id").alias("doc_id"), "class_id"))
    first = members.groupBy("class_id").agg(first_row().alias("first")).select(f"first.{ROW}")
    return drop_rows(keyed, members.join(first, ROW, "left_anti"), docs.columns, key)
