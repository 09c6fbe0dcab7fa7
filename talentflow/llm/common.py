"""Helpers shared by the operators of this package."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, scratch_path

# The column that names a row, whatever its id.
ROW = "_row_key"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared(df: DataFrame) -> DataFrame:
    """Cut the lineage of a narrow intermediate result that is read more than
    once: a reliable checkpoint in the shared folder, so a lost executor costs
    nothing but the tasks it was running."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def text_of(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, text) with null texts as empty; other columns never clash."""
    return df.select(named(id_col).alias("doc_id"), F.coalesce(named(text_col), F.lit("")).alias("text"))


def named(column: str) -> Column:
    """A top-level column, whatever characters its name has."""
    return F.col("`" + column.replace("`", "``") + "`")


def free_name(df: DataFrame, name: str) -> str:
    """``name``, made longer until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def with_row_key(docs: DataFrame, key: str = ROW) -> DataFrame:
    """``docs`` with a unique key per row that is the same at every scan: the
    place of the row in its Parquet file.  Anything but a plain Parquet scan is
    written once in the shared folder and read from there.  ``key`` must be a
    free name."""
    spark = docs.sparkSession
    plan = docs._jdf.queryExecution().analyzed()
    if plan.nodeName() != "LogicalRelation" or "parquet" not in plan.relation().toString().lower():
        path = scratch_path(spark, f"rows-{uuid.uuid4().hex}")
        docs.write.parquet(path)
        docs = spark.read.schema(docs.schema).parquet(path)
    columns = [named(c) for c in docs.columns]
    file, index, number = (free_name(docs, c) for c in ("_row_file", "_row_index", "_row_file_no"))
    placed = docs.select(*columns, docs.metadataColumn("_metadata")["file_path"].alias(file), docs.metadataColumn("_metadata")["row_index"].alias(index))
    names = sorted(r[0] for r in placed.select(file).distinct().collect())  # no more than the driver lists for a scan
    files = spark.createDataFrame(list(zip(names, range(len(names)))), f"{file} string, {number} long")
    place = F.shiftleft(number, 40) + F.col(index)
    return placed.join(F.broadcast(files), file).select(*columns, place.alias(key))


def keyed_texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(row key, doc_id, text) with null texts as empty; other columns, and
    their names, do not matter."""
    key = free_name(docs, ROW)
    rows = with_row_key(docs, key)
    return rows.select(F.col(key).alias(ROW), named(id_col).alias("doc_id"), F.coalesce(named(text_col), F.lit("")).alias("text"))


def number_rows(df: DataFrame) -> DataFrame:
    """Narrow rows with a row key, to be stored before they are read."""
    return df.withColumn(ROW, F.monotonically_increasing_id())


def drop_rows(rows: DataFrame, gone: DataFrame, columns: list[str], key: str = ROW) -> DataFrame:
    """``columns`` of the rows whose ``key`` is not among the row keys of
    ``gone``."""
    return rows.join(gone.select(F.col(ROW).alias(key)), key, "left_anti").select(*[named(c) for c in columns])


def first_row(*order: Column) -> Column:
    """Aggregate: struct with doc_id and row key of the first row by ``order``,
    then the smallest id (nulls last), then the smallest row key."""
    keys = [c.alias(f"o{i}") for i, c in enumerate(order)]
    return F.min(F.struct(*keys, F.col("doc_id").isNull().alias("no_id"), "doc_id", ROW))


def crc_mod(id_col: str | Column, n: int) -> Column:
    """crc32 of the id's decimal text, modulo n."""
    return F.crc32(F.col(id_col).cast("string") if isinstance(id_col, str) else id_col.cast("string")) % F.lit(n)


def sample_by_hash(rows: DataFrame, id_col: str, limit: int) -> DataFrame:
    """At most ``limit`` rows, chosen by a hash of the id: the same rows on
    every run, whatever the partitioning.  For narrow rows, to fit models."""
    return rows.orderBy(F.xxhash64(F.col(id_col).cast("string"), F.lit("sample")), F.col(id_col)).limit(limit)


def labelled_sample(docs: DataFrame, labels: DataFrame, limit: int) -> DataFrame:
    """(doc_id, text, label) of at most ``limit`` labelled ids.  Ids are drawn
    from the narrow ``labels`` (doc_id, label) alone; their bounded list is
    broadcast, so no text is sorted or shuffled."""
    chosen = sample_by_hash(labels.select("doc_id", "label"), "doc_id", limit)
    return text_of(docs, "doc_id", "text").join(F.broadcast(chosen), "doc_id")
