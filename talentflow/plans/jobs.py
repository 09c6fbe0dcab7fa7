"""Path-level jobs: what a scheduled run of the platform executes.

Each job reads tables by path, runs the DataFrame operators and writes the
result as a table; all take the caller's SparkSession.  ``python -m
talentflow <job> ...`` runs them from the command line (spark-submit).
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import presence, views
from ..operators.matching import build_profile, match_scores
from ..session import staged
from ..sources import landing, tables
from .silver import transform

GOLD_VIEWS = ("active_companies", "tech_trends", "duplicate_postings", "new_postings", "removed_postings")
HISTORY_VIEWS = ("posting_intervals",)  # over all batches, on request


def land_to_bronze(spark: SparkSession, landing_root: str, bronze_path: str, rejects_path: str,
                   targets: DataFrame | None = None, ingestion_date: dt.date | None = None, run_id: str | None = None) -> int:
    """S1-S5 as one batch job over the files landed since the last run;
    returns rows added.

    The landing root is listed without reading a file.  Files that an earlier
    run has finished are in a ledger next to Bronze with their modification
    time and are left out before any content is read; a file rewritten in place
    is read again.  Of the listing, the driver holds the names of the new files.  A run that failed is repeated with its ``run_id``: it reads
    the same files and replaces its own postings and rejects, under the date of
    its first try.  The files are parsed and exploded once into a staging
    folder; postings, rejects, what was fetched of every target, and the ledger
    are read from there.  Folders whose
    name starts with an underscore are hidden from readers of Bronze.
    """
    root, run = bronze_path.rstrip("/"), run_id or uuid.uuid4().hex
    day = tables.batch_day(spark, root, f"run-{run}", ingestion_date or dt.datetime.now(dt.timezone.utc).date())
    found = tables.list_files(spark, landing_root)
    ledger = f"{root}/_landed_files"
    if tables.path_exists(spark, ledger):
        finished = F.col("_metadata.file_modification_time").alias("finished")
        done = spark.read.schema("file string, modified timestamp, run string").parquet(ledger).filter(F.col("run") != run)
        r, d = found.alias("r"), done.select("file", "modified", finished).alias("d")
        # entries of earlier versions have no modification time: a file changed after their run is new
        same = F.coalesce(F.col("r.modified") == F.col("d.modified"), F.col("r.modified") <= F.col("d.finished"))
        found = r.join(d, (F.col("r.file") == F.col("d.file")) & same, "left_anti")
    staged_run = f"{root}/_landing/run={run}"
    tables.delete_path(spark, staged_run)
    found.write.parquet(f"{staged_run}/files")
    files = spark.read.parquet(f"{staged_run}/files")
    responses = landing.read_landed(spark, landing_root, [r.path for r in files.select("path").collect()])
    if targets is not None:
        responses = landing.gate_targets(responses, targets)
    landing.explode_all(responses, keep_empty=True).write.parquet(f"{staged_run}/rows")
    out = spark.read.parquet(f"{staged_run}/rows")
    ok = F.col("reject_reason").isNull()
    rejects = out.filter(~ok & (F.col("reject_reason") != landing.NO_POSTINGS)).select(*landing.REJECT_COLUMNS, F.lit(day).cast("date").alias("ingestion_date"), F.lit(run).alias("batch_id"))
    tables.replace_partitions(rejects, rejects_path, "ingestion_date", "batch_id")
    rows = tables.append_bronze(landing.to_bronze(out.filter(ok).drop("reject_reason"), day), bronze_path, run)
    fetches = landing.fetch_outcomes(out, day).withColumn("run", F.lit(run))
    tables.replace_partitions(fetches, tables.fetches_path(root), "ingestion_date", "run")
    tables.replace_partitions(files.select("file", "modified").withColumn("run", F.lit(run)), ledger, "run")
    tables.delete_path(spark, staged_run)
    return rows


def bronze_to_silver(spark: SparkSession, bronze_path: str, silver_path: str, since_date: dt.date | None = None,
                     rejects_path: str | None = None, full: bool = False) -> int:
    """P2, incremental: Bronze from the last merged date on (that date included)
    is mapped and merged, and with it every older date that has a partition not
    merged yet: one that arrived late, or was written again.  Only those dates
    are read; W1's order is kept next to the Silver rows.  Newest date and merged
    partitions are recorded next to Silver after each run; ``since_date``
    overrides them, and ``full`` recomputes from all of Bronze."""
    parts = staged(tables.bronze_parts(spark, bronze_path))  # listed before the merge, so nothing later is skipped
    late: list[dt.date] = []
    if since_date is None and not full:
        since_date = tables.high_water(spark, silver_path)
        if since_date is not None:
            late = tables.open_days(spark, silver_path, parts, since_date)
    read = parts if since_date is None else parts.filter(
        (F.col("ingestion_date") >= F.lit(since_date).cast("date")) | F.col("ingestion_date").isin(late)
    )
    newest = parts.agg(F.max("ingestion_date")).first()[0]
    on_error = "quarantine" if rejects_path else "fail"
    rows = transform(spark, bronze_path, silver_path, on_error=on_error, rejects_path=rejects_path, since_date=since_date, late_dates=late)
    if newest is not None:
        tables.record_high_water(spark, silver_path, newest)
    tables.record_merged(spark, silver_path, read)
    return rows


def gold_view(spark: SparkSession, name: str, silver_path: str, bronze_path: str | None = None,
              previous_date: dt.date | None = None, current_date: dt.date | None = None, fetch_evidence: bool = False) -> DataFrame:
    """One Gold view by name, over the current Silver snapshot (or Bronze for
    the new/removed views, which compare two batches, and ``posting_intervals``,
    which covers all).  With ``fetch_evidence`` a posting is removed only if its
    target was fetched completely."""
    if name == "posting_intervals":
        if bronze_path is None:
            raise ValueError(f"{name} needs bronze_path")
        return presence.presence_intervals(tables.read_bronze(spark, bronze_path))
    if name in ("new_postings", "removed_postings"):
        if bronze_path is None or previous_date is None or current_date is None:
            raise ValueError(f"{name} needs bronze_path, previous_date and current_date")
        bronze = tables.read_bronze(spark, bronze_path)
        if name == "new_postings":
            return views.new_postings(bronze, previous_date, current_date)
        if fetch_evidence:
            return presence.removed_with_evidence(bronze, tables.read_fetches(spark, bronze_path), previous_date, current_date)
        return views.removed_postings(bronze, previous_date, current_date)
    silver = tables.read_silver(spark, silver_path)
    if silver is None:
        raise ValueError(f"no Silver table at {silver_path}")
    if name == "active_companies":
        return views.active_companies(silver, ordered=False)
    if name == "tech_trends":
        return views.tech_trends(silver, ordered=False)
    if name == "duplicate_postings":
        return views.duplicate_postings(silver, ordered=False)
    raise ValueError(f"unknown view {name!r}; expected one of {GOLD_VIEWS + HISTORY_VIEWS}")


def write_gold(spark: SparkSession, gold_root: str, silver_path: str, bronze_path: str | None = None,
               previous_date: dt.date | None = None, current_date: dt.date | None = None,
               fetch_evidence: bool = False, names: tuple[str, ...] = GOLD_VIEWS) -> dict[str, int]:
    """Materialise the Gold views ``names`` as new snapshot versions; returns row
    counts.  The two views of two batches are left out without their dates."""
    out = {}
    for name in names:
        if name in ("new_postings", "removed_postings") and previous_date is None:
            continue
        df = gold_view(spark, name, silver_path, bronze_path, previous_date, current_date, fetch_evidence)
        out[name] = tables.write_snapshot(df, f"{gold_root.rstrip('/')}/{name}")
    return out


def match_cv(spark: SparkSession, silver_path: str, cv_text: str, years_experience: float, top_k: int | None = None) -> DataFrame:
    """P3 + P4 for one CV: the postings ranked by match score."""
    silver = tables.read_silver(spark, silver_path)
    if silver is None:
        raise ValueError(f"no Silver table at {silver_path}")
    return match_scores(silver, build_profile(spark, cv_text, years_experience), ordered=True, top_k=top_k)
