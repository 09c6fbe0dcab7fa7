"""Language identification with language-bitmask n-gram filters.

A bit-sliced Bloom filter is one table of bit masks, one bit per language.
Every character n-gram typical of a language sets that language's bit at
``HASHES`` places; the AND of the masks at an n-gram's places returns all
languages that hold it.  A text's languages are counted over its n-grams, the
counts are corrected for the filter's false positives, and the largest wins.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .chars import IS_LETTER, chunks, letters, q_grams
from .common import sample_by_hash, text_of
from .tokens import U64, mix

GRAM, HASHES, TABLE_BITS = 4, 3, 21
# The filters are fitted on at most so many documents of each language.
SAMPLE_PER_LANGUAGE = 2000
MAX_LANGUAGES = 64
# A language holds an n-gram whose share of its n-grams is at least this part
# of the share in any other language.
TYPICAL = 0.25
UNKNOWN = "und"


def places(grams: np.ndarray) -> Iterator[np.ndarray]:
    for k in range(HASHES):
        yield (mix(grams + U64(0xD6E8FEB86659FD93 * (k + 1) % (1 << 64))) >> U64(64 - TABLE_BITS)).astype(np.int64)


class Filter:
    """The fitted table, with each language's false-positive rate."""

    def __init__(self, languages: list[str], at: np.ndarray, masks: np.ndarray):
        self.languages = languages
        width = next(d for d in (np.uint8, np.uint16, np.uint32, np.uint64) if len(languages) <= np.dtype(d).itemsize * 8)
        self.table = np.zeros(1 << TABLE_BITS, width)
        self.table[at] = masks.astype(np.uint64).astype(width)
        fill = [np.count_nonzero(self.table >> width(b) & width(1)) / len(self.table) for b in range(len(languages))]
        self.false_rate = np.array(fill) ** HASHES

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        if not self.languages:  # nothing was learned
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        chars, bounds = letters(texts)
        grams, at = q_grams(chars, bounds, GRAM)
        mask = np.full(len(grams), np.iinfo(self.table.dtype).max, self.table.dtype)
        for place in places(grams):
            mask &= self.table[place]
        cuts = np.searchsorted(at, bounds)
        n = np.diff(cuts)[:, None]
        hits = np.empty((len(texts), len(self.languages)))
        for b in range(len(self.languages)):
            bit = (mask >> self.table.dtype.type(b)) & self.table.dtype.type(1)
            hits[:, b] = np.diff(np.concatenate([[0], np.cumsum(bit, dtype=np.int64)])[cuts])
        true = np.maximum((hits - n * self.false_rate) / (1 - self.false_rate), 0)
        some = np.diff(np.concatenate([[0], np.cumsum(IS_LETTER[chars])])[bounds]) > 0
        total = true.sum(axis=1)
        best = true.argmax(axis=1)
        score = np.where(total > 0, true[np.arange(len(texts)), best] / np.where(total > 0, total, 1), 1 / len(self.languages))
        names = [self.languages[b] if s else UNKNOWN for b, s in zip(best, some)]
        return names, np.where(some, score, 0.0)


def gram_counts(docs: DataFrame) -> DataFrame:
    """(lang, gram, n) summed per Arrow batch already."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, langs = batch.column(0).to_pylist(), np.array(batch.column(1).to_pylist())
            for at, part in chunks(texts):
                chars, bounds = letters(part)
                grams, where = q_grams(chars, bounds, GRAM)
                lang = langs[at : at + len(part)][np.searchsorted(bounds, where, "right") - 1]
                for name in np.unique(lang):
                    g, n = np.unique(grams[lang == name], return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([name] * len(g)), pa.array(g.view(np.int64)), pa.array(n, pa.int64())], names=["lang", "gram", "n"]
                    )

    return docs.select(F.coalesce("text", F.lit("")), "lang").mapInArrow(count, "lang string, gram bigint, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE_PER_LANGUAGE) -> Filter:
    """``docs``: doc_id, text; ``labels``: doc_id, label (the language, no
    nulls).  Sampled ids come from the narrow labels; what reaches the driver
    is the table, whose size does not depend on the input."""
    languages = sorted(r[0] for r in labels.select("label").distinct().limit(MAX_LANGUAGES + 1).collect())
    if len(languages) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    if not languages:
        return Filter([], np.zeros(0, np.int64), np.zeros(0, np.int64))
    chosen = [sample_by_hash(labels.select("doc_id", "label").filter(F.col("label") == name), "doc_id", sample) for name in languages]
    ids = F.broadcast(reduce(DataFrame.unionByName, chosen).withColumnRenamed("label", "lang"))
    counts = gram_counts(text_of(docs, "doc_id", "text").join(ids, "doc_id"))
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    shares = counts.join(F.broadcast(totals), "lang").select("gram", "lang", (F.col("n") / F.col("total")).alias("share"))
    bits = F.create_map(*[x for i, name in enumerate(languages) for x in (F.lit(name), F.lit(i))])
    held = (
        shares.groupBy("gram")
        .agg(F.max("share").alias("top"), F.collect_list(F.struct("lang", "share")).alias("langs"))
        .select("gram", F.explode(F.filter("langs", lambda x: x["share"] >= F.col("top") * TYPICAL)).alias("x"))
        .select("gram", F.call_function("shiftleft", F.lit(1).cast("long"), bits[F.col("x.lang")]).alias("mask"))
    )

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for place in places(np.asarray(batch.column(0)).view(U64)):
                yield pa.RecordBatch.from_arrays([pa.array(place), batch.column(1)], names=["place", "mask"])

    table = held.mapInArrow(spread, "place bigint, mask bigint").groupBy("place").agg(F.bit_or("mask").alias("mask")).toArrow()
    return Filter(languages, np.asarray(table.column("place")), np.asarray(table.column("mask")))


def predict(docs: DataFrame, model: Filter, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, lang_pred, score.  A text that is null or
    has no letter, and any text when no language was learned, is ``und`` with score 0; a text none of whose n-grams is known
    takes the first language, with an even score.  Repeated rows are scored
    each; other columns are ignored."""
    src = text_of(docs, id_col, text_col)
    shared_model = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, texts in chunks(batch.column(1).to_pylist()):
                names, score = shared_model.value.predict(texts)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, len(texts)), pa.array(names, pa.string()), pa.array(score)],
                    names=["doc_id", "lang_pred", "score"],
                )

    return src.mapInArrow(run, f"doc_id {src.schema['doc_id'].dataType.simpleString()}, lang_pred string, score double")
