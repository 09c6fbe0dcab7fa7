"""When postings were there: intervals over all batches, and removals that
rest on evidence of a fetch (X0-X2 beyond two batches)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .views import seen_in


def presence_intervals(bronze: DataFrame) -> DataFrame:
    """Maximal runs of consecutive batches that hold a key: ``job_id, interval_no``
    (from 1, per key), ``first_seen, last_seen, removed_on``.

    ``removed_on`` is the first batch after the run, NULL while the key is in the
    newest batch.  Batches are the distinct ingestion dates; rows without a date
    are in no batch.  Every row carries the date of the batch after its own, so
    two neighbours of a key's sorted dates belong together when one's next is the
    other: no numbering, and one shuffle.  The dates of a key are a set that is
    combined map-side (at most one entry per batch, whatever the number of rows),
    and the broadcast calendar has one row per day.
    """
    day = F.col("ingestion_date")
    calendar = (
        bronze.select("ingestion_date").filter(day.isNotNull()).distinct()
        .select("ingestion_date", F.lead("ingestion_date").over(Window.orderBy("ingestion_date")).alias("_next"))
    )
    key = F.concat_ws(":", F.col("source"), F.col("source_job_id")).alias("job_id")
    seen = (
        bronze.select(key, "ingestion_date")
        .join(F.broadcast(calendar), "ingestion_date")
        .groupBy("job_id")
        .agg(F.sort_array(F.collect_set(F.struct(day.alias("day"), F.col("_next").alias("next")))).alias("_seen"))
    )

    def opens(x: Column, i: Column) -> Column:
        return (i == 0) | (F.get("_seen", i - 1)["next"] != x["day"])

    def closes(x: Column, i: Column) -> Column:
        return (i == F.size("_seen") - 1) | (F.get("_seen", i + 1)["day"] != x["next"])

    runs = F.arrays_zip(F.filter("_seen", opens).alias("a"), F.filter("_seen", closes).alias("b"))
    return seen.select("job_id", F.posexplode(runs).alias("_no", "_run")).select(
        "job_id",
        (F.col("_no") + 1).alias("interval_no"),
        F.col("_run.a.day").alias("first_seen"),
        F.col("_run.b.day").alias("last_seen"),
        F.col("_run.b.next").alias("removed_on"),
    )


def _open_at(day: dt.date | str) -> Column:
    d = F.lit(day).cast("date")
    return (F.col("first_seen") <= d) & (F.col("removed_on").isNull() | (F.col("removed_on") > d))


def open_on(intervals: DataFrame, day: dt.date | str) -> DataFrame:
    """Keys open on ``day``: seen by then and not yet found missing.  Between two
    batches the state of the earlier one holds.  Intervals of a key do not
    overlap, so no ``distinct`` is needed."""
    return intervals.filter(_open_at(day)).select("job_id")


def changes_between(intervals: DataFrame, previous_date: dt.date | str, current_date: dt.date | str) -> DataFrame:
    """X1 and X2 for any two dates, from the intervals alone: ``job_id, change``
    (``new`` or ``removed``)."""
    was, now = _open_at(previous_date), _open_at(current_date)
    both = (
        intervals.filter(was | now).select("job_id", was.alias("_was"), now.alias("_now"))
        .groupBy("job_id").agg(F.max("_was").alias("_was"), F.max("_now").alias("_now"))
    )
    change = F.when(F.col("_now") & ~F.col("_was"), F.lit("new")).when(F.col("_was") & ~F.col("_now"), F.lit("removed"))
    return both.select("job_id", change.alias("change")).filter("change is not null")


def activity_by_day(intervals: DataFrame) -> DataFrame:
    """Per date on which something changed: ``day, new_count, returned_count,
    removed_count, open_count``.  A key that was open before and comes back counts
    as returned; ``open_count`` is a running sum over one row per day."""
    starts = F.struct(
        F.col("first_seen").alias("day"), (F.col("interval_no") == 1).cast("long").alias("new"),
        (F.col("interval_no") > 1).cast("long").alias("returned"), F.lit(0).cast("long").alias("removed"),
    )
    ends = F.struct(
        F.col("removed_on").alias("day"), F.lit(0).cast("long").alias("new"),
        F.lit(0).cast("long").alias("returned"), F.lit(1).cast("long").alias("removed"),
    )
    changes = intervals.select(F.explode(F.array(starts, ends)).alias("c")).filter("c.day is not null")
    per_day = changes.groupBy(F.col("c.day").alias("day")).agg(*[F.sum(f"c.{n}").alias(f"{n}_count") for n in ("new", "returned", "removed")])
    balance = F.col("new_count") + F.col("returned_count") - F.col("removed_count")
    return per_day.withColumn("open_count", F.sum(balance).over(Window.orderBy("day")))


def removed_with_evidence(bronze: DataFrame, fetches: DataFrame, previous_date: dt.date | str, current_date: dt.date | str) -> DataFrame:
    """X2 with evidence: keys of the previous batch that are not in the current
    one, and whose every target was fetched completely for it.

    ``fetches`` (see ``sources.landing.fetch_outcomes``) says what was fetched: a
    target with an empty but successful answer reports its postings as removed, a
    target that was not fetched, or only in part, does not.  Of several fetches of
    a target on one date a complete one suffices.  A target with a null source or
    name has no evidence.
    """
    pair = ["source", "company_identifier"]
    complete = (
        fetches.filter((F.col("ingestion_date") == F.lit(current_date).cast("date")) & F.col("complete"))
        .select(*pair, F.lit(True).alias("_complete")).distinct()
    )
    per_target = seen_in(bronze, previous_date, current_date, *pair, "job_id")  # once per target and key before the join
    sure = ~F.col("_was") | F.coalesce("_complete", F.lit(False))
    keys = (
        per_target.join(complete, pair, "left")
        .select("job_id", "_was", "_now", sure.alias("_sure"))
        .groupBy("job_id")
        .agg(F.max("_was").alias("_was"), F.max("_now").alias("_now"), F.min("_sure").alias("_sure"))
    )
    return keys.filter(F.col("_was") & ~F.col("_now") & F.col("_sure")).select(
        "job_id", F.lit(current_date).cast("date").alias("detected_as_removed_on")
    )
