"""Bronze -> Silver (P2) and skill enrichment."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..catalogs import TECHNOLOGY_CATALOG, Catalog
from ..functions.terms import extract_terms
from ..operators.latest import ORDER, latest_per_key, latest_postings, newer_than_current, order_columns, silver_order, without_payload
from ..operators.normalize import normalize, silver_projection, split_rejects
from ..schemas import SILVER
from ..sources.tables import delete_path, read_bronze, read_snapshot, replace_partitions, upsert_snapshot


def enrich_with_technologies(silver: DataFrame, catalog: Catalog = TECHNOLOGY_CATALOG) -> DataFrame:
    """(re)compute ``technologies`` from ``description``; never NULL."""
    return silver.withColumn("technologies", extract_terms("description", catalog))


def silver_batch(bronze: DataFrame, on_error: str = "fail") -> tuple[DataFrame, DataFrame]:
    """Normalise, keep the latest good row per posting, extract skills.

    Returns (Silver rows in schema order, rejected Bronze rows).  Extraction
    runs after the de-duplication, on one row per posting.
    """
    return latest_silver(normalize(bronze), on_error)


def latest_silver(mapped: DataFrame, on_error: str = "fail", keep_order: bool = False) -> tuple[DataFrame, DataFrame]:
    """W1 + P1 over normalised rows (see :func:`silver_batch`).  With
    ``keep_order`` the columns W1 orders by follow the Silver columns.

    With ``on_error='quarantine'`` rejected rows are ranked after every good
    row of their key and dropped after the window, which equals dropping them
    first; filtering first would make Catalyst push the reject test below the
    normalising projections and evaluate the mapping twice.
    """
    if on_error == "quarantine":
        latest = latest_per_key(without_payload(mapped), "job_id", [F.col("reject_reason").isNull().desc(), *silver_order()])
        good = latest.filter(F.col("reject_reason").isNull()).drop("reject_reason")
        rejects = mapped.filter(F.col("reject_reason").isNotNull())
    else:
        checked, rejects = split_rejects(mapped, on_error)
        good = latest_postings(checked)
    rows = enrich_with_technologies(good)
    return (silver_projection(rows, order_columns()) if keep_order else silver_projection(rows)), rejects


def transform(
    spark: SparkSession,
    bronze_path: str,
    silver_path: str,
    on_error: str = "fail",
    rejects_path: str | None = None,
    since_date=None,
    late_dates: Sequence = (),
) -> int:
    """Compute the current state from Bronze and upsert it into the Silver
    snapshot table.  Returns the batch size (0 writes nothing).

    By default all of Bronze is re-read, as upstream.  With ``since_date``
    only the batches of that date and later are read (partition pruning), the
    date itself included, since more of it may have arrived, and those of the
    ``late_dates``; merging a row again changes nothing.  Silver's files keep
    what W1 orders by next to the Silver columns (readers of Silver do not see
    it), so only rows that beat the stored row are upserted, whatever their
    date: the result is that of a full recompute.

    With ``on_error='quarantine'`` bad rows are written to ``rejects_path``
    (required then) instead of failing the job.
    """
    bronze = read_bronze(spark, bronze_path)
    if since_date is not None:
        day = F.col("ingestion_date")
        wanted = day >= F.lit(since_date).cast("date")
        bronze = bronze.filter(wanted | day.isin(*[F.lit(d).cast("date") for d in late_dates]) if late_dates else wanted)
    mapped = normalize(bronze)
    if on_error == "quarantine":
        if rejects_path is None:
            raise ValueError("rejects_path is required with on_error='quarantine'")
        # Normalise once into a staging table next to Silver: the rejects are
        # then a pushed-down Parquet filter and the batch reads the same files.
        staged = f"{silver_path.rstrip('/')}/_normalized/run={uuid.uuid4().hex}"
        mapped.write.parquet(staged)
        mapped = spark.read.parquet(staged)
        # the rejects of a Bronze date replace those of an earlier run over it
        replace_partitions(mapped.filter(F.col("reject_reason").isNotNull()), rejects_path, "ingestion_date")
    batch, _ = latest_silver(mapped, on_error, keep_order=True)
    if since_date is not None:
        current = read_snapshot(spark, silver_path, StructType(SILVER.fields + ORDER.fields))
        if current is not None:
            batch = newer_than_current(batch, current, "job_id")
    written = upsert_snapshot(batch, silver_path, "job_id")
    if on_error == "quarantine":
        delete_path(spark, staged)  # the new version and the rejects are written
    return written
