"""Table sinks and scans without a transactional table format.

* Bronze: Parquet partitioned by source, date and batch; batch and stream
  writers share the layout, and a batch that is retried replaces its own rows.
* Silver and Gold: *snapshot* tables.  Every write produces a new complete
  version ``<path>/v=<n>/``; a version counts once Spark's commit protocol has
  written its ``_SUCCESS`` marker, and readers always take the newest counted
  version.  Nothing is ever overwritten in place (overwriting a Parquet path
  that the same plan reads deletes the input first), and a job that dies half
  way leaves an uncounted version that the next write replaces.
"""

from __future__ import annotations

import datetime as dt
import re
import time
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.latest import upsert_rows
from ..schemas import BRONZE, BRONZE_COLUMNS, SILVER

_VERSION = re.compile(r"^v=(\d+)$")


# ------------------------------------------------------------------ Bronze --

BRONZE_LAYOUT = ("source", "ingestion_date", "batch_id")


def append_bronze(df: DataFrame, path: str, batch_id: str | None = None) -> int:
    """Add one batch, partitioned by ``source, ingestion_date, batch_id``.

    Returns the number of rows written (counted during the write through an
    ``Observation``, so the batch is evaluated once).  A batch that is written
    again under its ``batch_id`` replaces its own rows; without an id a fresh
    one is made.  An empty batch leaves no table behind.
    """
    spark = df.sparkSession
    existed = path_exists(spark, path)
    obs = Observation("bronze_append")
    (
        df.select(*BRONZE_COLUMNS)
        .observe(obs, F.count(F.lit(1)).alias("rows"))
        .withColumn("batch_id", F.lit(batch_id or uuid.uuid4().hex))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*BRONZE_LAYOUT)
        .parquet(path)
    )
    rows = int(obs.get["rows"])
    if not rows and not existed:
        delete_path(spark, path)
    return rows


def replace_partitions(df: DataFrame, path: str, *keys: str) -> None:
    """Write ``df`` so that the partitions it has rows for are replaced."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(path)


def read_bronze(spark: SparkSession, path: str) -> DataFrame:
    """The whole Bronze history with its declared schema (partition values
    are not re-typed); date predicates prune partitions."""
    return spark.read.schema(BRONZE).parquet(path).select(*BRONZE_COLUMNS)


FETCHES = "source string, company_identifier string, ingestion_date date, failed_responses bigint, postings bigint, complete boolean, run string"


def fetches_path(bronze_path: str) -> str:
    return f"{bronze_path.rstrip('/')}/_fetches"


def read_fetches(spark: SparkSession, bronze_path: str) -> DataFrame:
    """What the landing runs fetched of every target, a row per run and target."""
    path = fetches_path(bronze_path)
    if not path_exists(spark, path):
        return spark.createDataFrame([], FETCHES)
    return spark.read.schema(FETCHES).parquet(path)


def batch_day(spark: SparkSession, root: str, batch_id: str, day: dt.date) -> dt.date:
    """The date under which a batch was first tried.  It is recorded as an empty
    folder, so a retry after midnight writes to the same partition."""
    fs, p, jvm = _fs(spark, f"{root.rstrip('/')}/_batch_days/{batch_id}")
    if not fs.exists(p) or not fs.listStatus(p):
        fs.mkdirs(jvm.org.apache.hadoop.fs.Path(p, day.isoformat()))
    return min(dt.date.fromisoformat(st.getPath().getName()) for st in fs.listStatus(p))


def high_water(spark: SparkSession, path: str) -> dt.date | None:
    """The newest Bronze date merged into the snapshot table at ``path``."""
    fs, p, _ = _fs(spark, f"{path.rstrip('/')}/_high_water")
    days = [dt.date.fromisoformat(st.getPath().getName()) for st in fs.listStatus(p)] if fs.exists(p) else []
    return max(days, default=None)


def record_high_water(spark: SparkSession, path: str, day: dt.date) -> None:
    fs, p, _ = _fs(spark, f"{path.rstrip('/')}/_high_water/{day.isoformat()}")
    fs.mkdirs(p)


def list_files(spark: SparkSession, root: str) -> DataFrame:
    """The files below ``root`` as a scan of their names: path (as readers take
    it), file (as ``_metadata.file_path`` spells it), modified.  No content is
    read.  Files and folders whose names start with ``_`` or ``.`` are left out."""
    return (
        spark.read.format("binaryFile")
        .schema("path string, modificationTime timestamp, length bigint, content binary")
        .option("recursiveFileLookup", True)
        .load(root)
        .select("path", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_modification_time").alias("modified"))
    )


def bronze_parts(spark: SparkSession, path: str) -> DataFrame:
    """(part, ingestion_date, files, newest) per partition folder of Bronze, as
    listed now.  A batch that is written again gets newer files."""
    part = F.regexp_extract("file", r"(source=.*)/[^/]*$", 1)
    day = F.to_date(F.nullif(F.regexp_extract("file", r"/ingestion_date=(\d{4}-\d\d-\d\d)/", 1), F.lit("")))
    files = list_files(spark, path).select(part.alias("part"), day.alias("ingestion_date"), "modified")
    return files.groupBy("part", "ingestion_date").agg(F.count("*").alias("files"), F.max("modified").alias("newest"))


MERGED = "part string, ingestion_date date, files bigint, newest timestamp"


def open_days(spark: SparkSession, silver_path: str, parts: DataFrame, before: dt.date) -> list[dt.date]:
    """Dates earlier than ``before`` under which a Bronze partition was added or
    rewritten since it was merged into the table at ``silver_path``: the only
    thing collected of the listing."""
    older = parts.filter(F.col("ingestion_date") < F.lit(before).cast("date"))
    ledger = f"{silver_path.rstrip('/')}/_merged_parts"
    if path_exists(spark, ledger):
        older = older.join(spark.read.schema(MERGED).parquet(ledger), ["part", "ingestion_date", "files", "newest"], "left_anti")
    return sorted(r.ingestion_date for r in older.select("ingestion_date").distinct().collect())


def record_merged(spark: SparkSession, silver_path: str, parts: DataFrame) -> None:
    """Add the partitions of ``parts`` to the ledger of merged ones, a row each."""
    ledger = f"{silver_path.rstrip('/')}/_merged_parts"
    if path_exists(spark, ledger):
        parts = parts.join(spark.read.schema(MERGED).parquet(ledger), parts.columns, "left_anti")
    parts.coalesce(1).write.mode("append").parquet(ledger)


# --------------------------------------------------------------- snapshots --

def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p, jvm


def versions(spark: SparkSession, path: str) -> list[int]:
    """Committed versions (with ``_SUCCESS``), ascending."""
    fs, p, jvm = _fs(spark, path)
    if not fs.exists(p):
        return []
    out = []
    for st in fs.listStatus(p):
        m = _VERSION.match(st.getPath().getName())
        if m and st.isDirectory() and fs.exists(jvm.org.apache.hadoop.fs.Path(st.getPath(), "_SUCCESS")):
            out.append(int(m.group(1)))
    return sorted(out)


def _next_version(spark: SparkSession, path: str) -> int:
    """One past the highest version directory, counted or not, so an
    interrupted write is never reused as a target."""
    fs, p, _ = _fs(spark, path)
    if not fs.exists(p):
        return 0
    seen = [int(m.group(1)) for st in fs.listStatus(p) if (m := _VERSION.match(st.getPath().getName()))]
    return max(seen, default=-1) + 1


def latest_path(spark: SparkSession, path: str) -> str | None:
    vs = versions(spark, path)
    return f"{path.rstrip('/')}/v={vs[-1]}" if vs else None


def read_snapshot(spark: SparkSession, path: str, schema=None) -> DataFrame | None:
    """Newest complete version, or None when the table does not exist."""
    lp = latest_path(spark, path)
    if lp is None:
        return None
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(lp)


def write_snapshot(df: DataFrame, path: str) -> int:
    """Write ``df`` as a new version; returns its row count (one evaluation)."""
    spark = df.sparkSession
    target = f"{path.rstrip('/')}/v={_next_version(spark, path)}"
    obs = Observation("snapshot_write")
    df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("error").parquet(target)
    return int(obs.get["rows"])


def read_silver(spark: SparkSession, path: str) -> DataFrame | None:
    return read_snapshot(spark, path, SILVER)


def upsert_snapshot(batch: DataFrame, path: str, key: str = "job_id") -> int:
    """New version = batch  UNION  (current rows whose key is not in batch).

    Every column of a matched row is replaced; rows are never deleted.  The
    batch is first written once next to the table (``_batches/b=<n>``), which
    counts it and cuts its lineage, so the union and the anti join read files
    instead of recomputing the batch.  The anti join shuffles on ``key``, or
    broadcasts the batch keys when AQE measures them small.  Returns the batch
    size, as upstream; an empty batch writes nothing.
    """
    spark = batch.sparkSession
    n = _next_version(spark, path)
    staged_path = f"{path.rstrip('/')}/_batches/b={n}"
    obs = Observation("upsert_batch")
    batch.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(staged_path)
    rows = int(obs.get["rows"])
    if rows == 0:
        delete_path(spark, staged_path)
        return 0
    staged = spark.read.schema(batch.schema).parquet(staged_path)
    current = read_snapshot(spark, path, batch.schema)
    merged = staged if current is None else upsert_rows(current, staged, key)
    merged.write.mode("error").parquet(f"{path.rstrip('/')}/v={n}")
    delete_path(spark, staged_path)  # version n is committed; the staging copy is garbage
    return rows


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p, _ = _fs(spark, path)
    return fs.exists(p)


def delete_path(spark: SparkSession, path: str) -> None:
    """Recursively delete ``path`` (a staging folder this library wrote)."""
    fs, p, _ = _fs(spark, path)
    if fs.exists(p):
        fs.delete(p, True)


def vacuum(spark: SparkSession, path: str, keep: int = 2, staging_hours: float = 24.0) -> list[str]:
    """Delete all but the newest ``keep`` committed versions of a snapshot
    table, older versions left behind by interrupted writes, and staging folders
    that nothing has touched for ``staging_hours`` (younger ones may belong to
    a job in flight).  Returns what was deleted.  Readers of the newest version
    are never affected."""
    if keep < 1:
        raise ValueError("keep must be at least 1")
    fs, p, jvm = _fs(spark, path)
    if not fs.exists(p):
        return []
    committed = versions(spark, path)
    survivors = set(committed[-keep:])
    too_old = (time.time() - staging_hours * 3600) * 1000
    deleted = []
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        m = _VERSION.match(name)
        # only versions older than the newest committed one: anything newer may
        # be a write in flight
        stale = bool(m) and bool(committed) and int(m.group(1)) < committed[-1] and int(m.group(1)) not in survivors
        if stale:
            fs.delete(st.getPath(), True)
            deleted.append(name)
        elif name in ("_batches", "_normalized"):
            for run in fs.listStatus(st.getPath()):
                newest = max([run.getModificationTime(), *(f.getModificationTime() for f in fs.listStatus(run.getPath()))])
                if newest <= too_old:
                    fs.delete(run.getPath(), True)
                    deleted.append(f"{name}/{run.getPath().getName()}")
    return sorted(deleted)
