"""Exact deduplication by progressive refinement (DataFrame operations only).

1. length:      one narrow pass keeps the normalised length and a hash of the
                first ``prefix`` characters of every text; a length that
                occurs once settles its row;
2. prefix hash: within a length, a prefix hash that occurs once settles its row;
3. full hash:   only the surviving rows are read again and hashed whole.

Groups are counted by partial aggregates (a group of any size arrives at its
reducer as one row per task) and brought back by joins whose group side has
one row per group, which adaptive skew handling splits for hot groups.
Rows are told apart by a row key, never by their id, which may be null or
repeated.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ROW, drop_rows, first_row, free_name, named, shared, with_row_key

PREFIX_CHARS = 256
# The deleted characters: space and \t \n \v \f \r.
BLANKS = (" ", "\t", "\n", "\x0b", "\x0c", "\r")


def normalised(text: Column) -> Column:
    return reduce(lambda c, b: F.replace(c, F.lit(b), F.lit("")), BLANKS, text)


def duplicate_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", prefix: int = PREFIX_CHARS, key: str | None = None
) -> DataFrame:
    """One row per row of ``docs`` that has at least one equal text: row key,
    doc_id, keep_row, keep_id, group_size, text_sha256.

    Null and empty texts are equal to each other.  The row with the most code
    points in the original text stays, ties go to the smallest id (null ids
    last), then to the smallest row key.  Rows that repeat an id count as that
    many rows of the group.  An empty table gives an empty result; other columns
    of ``docs`` are ignored.  ``key`` names the row key where ``docs`` has one.
    """
    own = key or free_name(docs, ROW)
    rows = docs if key else with_row_key(docs, own)
    base = rows.select(F.col(own).alias(ROW), named(id_col).alias("doc_id"), F.coalesce(named(text_col), F.lit("")).alias("text"))
    norm = normalised(F.col("text"))
    keys = shared(
        base.select(ROW, norm.alias("norm")).select(
            ROW,
            F.octet_length("norm").alias("n_bytes"),
            F.xxhash64(F.substring("norm", 1, prefix)).alias("head"),
        )
    )
    # A group of (length, prefix) lies within one length group, so a single
    # partial aggregate settles both levels.
    # Group tables are stored before the join back: both of its sides are then
    # plain exchanges, which adaptive execution splits at a hot group.
    alive = shared(keys.groupBy("n_bytes", "head").count().filter("count > 1").select("n_bytes", "head"))
    survivors = keys.join(alive, ["n_bytes", "head"], "left_semi").select(ROW)
    full = shared(
        base.join(survivors, ROW, "left_semi").select(
            ROW, "doc_id", F.char_length("text").alias("n_chars"), F.sha2(normalised(F.col("text")), 256).alias("text_sha256")
        )
    )
    return full.join(_groups(full), "text_sha256").select(ROW, "doc_id", "keep_row", "keep_id", "group_size", "text_sha256")


def _groups(hashed: DataFrame) -> DataFrame:
    """(text_sha256, group_size, keep_id, keep_row) of the texts that occur
    more than once among (row key, doc_id, n_chars, text_sha256)."""
    return shared(
        hashed.groupBy("text_sha256")
        .agg(F.count("*").alias("group_size"), first_row(-F.col("n_chars")).alias("first"))
        .filter("group_size > 1")
        .select("text_sha256", "group_size", F.col("first.doc_id").alias("keep_id"), F.col(f"first.{ROW}").alias("keep_row"))
    )


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", prefix: int = PREFIX_CHARS) -> DataFrame:
    """The documents that stay, with all their columns (one per equal text)."""
    key = free_name(docs, ROW)
    rows = with_row_key(docs, key)
    gone = duplicate_groups(rows, id_col, text_col, prefix, key).filter(F.col(ROW) != F.col("keep_row"))
    return drop_rows(rows, gone, docs.columns, key)


def dedup_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", prefix: int = PREFIX_CHARS) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id (null if no row of the group
    has an id), group_size, kept, text_sha256.

    Groups come from the refinement; a row that its length or prefix settled is
    a group of its own.  The hash of every text is a column of the report and
    decides nothing.
    """
    key = free_name(docs, ROW)
    rows = with_row_key(docs, key)
    copies = duplicate_groups(rows, id_col, text_col, prefix, key).select(ROW, "keep_row", "keep_id", "group_size")
    text = F.coalesce(named(text_col), F.lit(""))
    hashed = rows.select(F.col(key).alias(ROW), named(id_col).alias("doc_id"), F.sha2(normalised(text), 256).alias("text_sha256"))
    single = F.col("group_size").isNull()
    return hashed.join(copies, ROW, "left").select(
        "doc_id",
        F.when(single, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        (single | (F.col(ROW) == F.col("keep_row"))).alias("kept"),
        "text_sha256",
    )


ORACLE = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS t
  FROM documents
), g AS (
  SELECT t, count(*) AS group_size, arg_min(doc_id, (-n, doc_id)) AS keep_id FROM d GROUP BY t
)
SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id AS kept, sha256(d.t) AS text_sha256
FROM d JOIN g USING (t)
"""
