"""Gold counts kept up to date by signed changes (S9 with A1, A2).

The views A1 and A2 are sums, so they need not read Silver again after every
batch.  Partial counts are stored next to Gold: postings per (company, source)
and mentions per technology.  An upsert adds its batch rows with +1 and the
rows that it replaces with -1; only these changes are aggregated and merged into
the stored counts, which have one row per group.

Counts carry the number of the Silver version they belong to.  A job that died
between the upsert and the counts, or a batch merged by other means, leaves
counts of an older version: the next run sees that and counts Silver anew.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.arrays import explode_rows
from ..session import scratch_path, staged
from ..sources import tables

VERSION = "silver_version"
SIGNED = ["company", "source", "technologies"]


def signed_changes(current: DataFrame | None, batch: DataFrame, key: str = "job_id") -> DataFrame:
    """(company, source, technologies, sign): +1 for every row of ``batch``, -1
    for every row of ``current`` that it replaces.  A null key replaces nothing,
    as in the upsert."""
    added = batch.select(*SIGNED, F.lit(1).alias("sign"))
    if current is None:
        return added
    replaced = current.join(batch.select(key), key, "left_semi")
    return added.union(replaced.select(*SIGNED, F.lit(-1).alias("sign")))


def _company_counts(changes: DataFrame) -> DataFrame:
    return _summed(changes.select("company", "source", F.col("sign").cast("long").alias("n")), "company", "source")


def _technology_counts(changes: DataFrame) -> DataFrame:
    mentions = explode_rows(changes, F.col("technologies"), "technology", keep=["sign"])
    return _summed(mentions.select("technology", F.col("sign").cast("long").alias("n")), "technology")


def _summed(rows: DataFrame, *keys: str) -> DataFrame:
    """Sums of ``n`` by ``keys`` (nulls are a group); groups that cancel out go."""
    return rows.groupBy(*keys).agg(F.sum("n").alias("n")).filter("n != 0")


COUNTS = {"company_source": (_company_counts, ("company", "source")), "technology": (_technology_counts, ("technology",))}


def counts_path(gold_root: str, name: str) -> str:
    return f"{gold_root.rstrip('/')}/_counts/{name}"


def _version(spark: SparkSession, silver_path: str) -> int | None:
    committed = tables.versions(spark, silver_path)
    return committed[-1] if committed else None


def _stored(spark: SparkSession, path: str, version: int | None) -> DataFrame | None:
    """The stored counts, if they are those of Silver's ``version``."""
    counts = tables.read_snapshot(spark, path)
    row = None if counts is None else counts.select(VERSION).first()
    return counts.drop(VERSION) if row is not None and row[0] == version else None


def _write(counts: DataFrame, path: str, version: int) -> None:
    tables.write_snapshot(counts.withColumn(VERSION, F.lit(version).cast("long")), path)


def upsert_and_count(batch: DataFrame, silver_path: str, gold_root: str) -> int:
    """S8, then the stored counts brought to the new Silver version.  ``batch`` has
    one row per key; it is evaluated once.  Returns the batch size; an empty batch
    changes nothing."""
    spark = batch.sparkSession
    copy = scratch_path(spark, "gold", uuid.uuid4().hex)
    batch.write.parquet(copy)
    batch = spark.read.schema(batch.schema).parquet(copy)
    before = _version(spark, silver_path)
    changes = staged(signed_changes(tables.read_silver(spark, silver_path), batch))
    rows = tables.upsert_snapshot(batch, silver_path)
    if rows:
        after = _version(spark, silver_path)
        for name, (count, keys) in COUNTS.items():
            path = counts_path(gold_root, name)
            stored = _stored(spark, path, before)
            if stored is None:
                _write(count(_all_rows(spark, silver_path)), path, after)
            else:
                _write(_summed(stored.unionByName(count(changes)), *keys), path, after)
    tables.delete_path(spark, copy)
    return rows


def _all_rows(spark: SparkSession, silver_path: str) -> DataFrame:
    return signed_changes(None, tables.read_silver(spark, silver_path))


def current_counts(spark: SparkSession, name: str, silver_path: str, gold_root: str) -> DataFrame:
    """The counts ``name`` of the current Silver version: the stored ones, or,
    where they are of another version or missing, counted from Silver."""
    count, _ = COUNTS[name]
    stored = _stored(spark, counts_path(gold_root, name), _version(spark, silver_path))
    return stored if stored is not None else count(_all_rows(spark, silver_path))


def active_companies(spark: SparkSession, silver_path: str, gold_root: str) -> DataFrame:
    """A1 from the counts (not ordered)."""
    counts = current_counts(spark, "company_source", silver_path, gold_root)
    return counts.groupBy("company").agg(
        F.sum("n").alias("open_postings_count"), F.count("source").alias("distinct_sources")
    )


def tech_trends(spark: SparkSession, silver_path: str, gold_root: str) -> DataFrame:
    """A2 from the counts (not ordered)."""
    counts = current_counts(spark, "technology", silver_path, gold_root)
    return counts.select("technology", F.col("n").alias("mentions_count"))
