"""Landed responses -> Bronze as a Structured Streaming query.

New response files under ``root/source=<s>/company_identifier=<c>/`` are
picked up incrementally (the stream's checkpoint remembers which files were
done), gated by the target list, exploded into postings and appended to
Bronze.  Rejected responses go to a side table.

Each micro-batch writes under its own ``batch_id`` partition with dynamic
partition overwrite and under the date of its first try, so a batch that is
retried after a failure (executor loss, driver restart from the checkpoint)
replaces its own earlier output instead of duplicating it.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..sources import tables
from ..sources.landing import LANDED_SCHEMA, REJECT_COLUMNS, explode_all, gate_targets, to_bronze


def landing_stream(spark: SparkSession, root: str, max_files_per_trigger: int | None = None, per_line: bool = False) -> DataFrame:
    """Streaming DataFrame of responses: ``source, company_identifier, fetched_at, body``.

    One file is one response, or with ``per_line`` one line is one response
    (JSON Lines landing, many responses per file)."""
    reader = spark.readStream.format("text").option("wholetext", not per_line).schema(LANDED_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(root).select(
        "source",
        "company_identifier",
        F.col("_metadata.file_modification_time").alias("fetched_at"),
        F.col("value").alias("body"),
    )


def _batch_writer(bronze_path: str, rejects_path: str, ingestion_date: dt.date | None):
    root = bronze_path.rstrip("/")

    def write(batch: DataFrame, batch_id: int) -> None:
        spark, name = batch.sparkSession, f"stream-{batch_id}"
        day = tables.batch_day(spark, root, name, ingestion_date or dt.datetime.now(dt.timezone.utc).date())
        # the micro-batch is parsed and exploded once, into a folder all executors share
        staged = f"{root}/_landing/{name}"
        explode_all(batch).write.mode("overwrite").parquet(staged)
        out = spark.read.parquet(staged)
        ok = F.col("reject_reason").isNull()
        # one shuffle on the partition columns: few files per folder
        rows = to_bronze(out.filter(ok).drop("reject_reason"), day).repartition("source", "company_identifier")
        tables.append_bronze(rows, bronze_path, name)
        rejects = out.filter(~ok).select(
            *REJECT_COLUMNS, F.lit(day).cast("date").alias("ingestion_date"), F.lit(name).alias("batch_id")
        )
        tables.replace_partitions(rejects, rejects_path, "ingestion_date", "batch_id")
        tables.delete_path(spark, staged)

    return write


def start_landing_stream(
    spark: SparkSession,
    landing_root: str,
    bronze_path: str,
    rejects_path: str,
    checkpoint_location: str,
    targets: DataFrame | None = None,
    available_now: bool = True,
    processing_time: str | None = None,
    ingestion_date: dt.date | None = None,
    max_files_per_trigger: int | None = None,
    per_line: bool = False,
) -> StreamingQuery:
    """Start the landing -> Bronze stream.

    ``available_now`` processes everything landed so far and stops (a
    scheduled incremental run); otherwise ``processing_time`` (e.g.
    ``'5 minutes'``) keeps it running.  ``targets`` is a small
    ``(source, company_identifier, risk_tier)`` dimension, broadcast to the
    gate.  ``ingestion_date`` defaults to the UTC date of each micro-batch.
    """
    responses = landing_stream(spark, landing_root, max_files_per_trigger, per_line)
    if targets is not None:
        responses = gate_targets(responses, targets)
    writer = (
        responses.writeStream.foreachBatch(_batch_writer(bronze_path, rejects_path, ingestion_date))
        .option("checkpointLocation", checkpoint_location)
        .queryName(f"landing_to_bronze_{abs(hash(bronze_path)) % 10**8}")
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()
