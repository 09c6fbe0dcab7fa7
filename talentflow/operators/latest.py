"""Latest row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, IntegerType, LongType, StructField, StructType, TimestampType
from pyspark.sql.window import Window


def latest_per_key(df: DataFrame, key: str | Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Keep the first row of each key under ``order``.

    ``row_number() = 1`` is planned as a WindowGroupLimit: a partial top-1 runs
    in every map task before the shuffle, so a hot key sends at most one row
    per map task across the network.
    """
    keys = [key] if isinstance(key, str) else list(key)
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def payload_hashes() -> list[Column]:
    """Two independent hashes (64 + 32 bits) of the payload text: the last tie-breakers
    of W1, so the window shuffle carries 16 bytes instead of the document."""
    return [F.xxhash64("raw_payload").alias("_payload_h1"), F.hash("raw_payload").alias("_payload_h2")]


def silver_order() -> list[Column]:
    """W1's total order: newest publication first (NULLs last), then the newest
    batch, the newest fetch, and the payload hashes so ties are deterministic.
    Needs the columns of :func:`payload_hashes`."""
    return [
        F.col("publication_date").desc_nulls_last(),
        F.col("ingestion_date").desc_nulls_last(),
        F.col("fetched_at").desc_nulls_last(),
        F.col("_payload_h1").desc(),
        F.col("_payload_h2").desc(),
    ]


def without_payload(mapped: DataFrame) -> DataFrame:
    """Replace ``raw_payload`` by its hashes before a shuffle."""
    return mapped.select(*[c for c in mapped.columns if c != "raw_payload"], *payload_hashes())


def latest_postings(mapped: DataFrame) -> DataFrame:
    """W1 over normalised Bronze rows, keyed by ``job_id``; payload hashes stay."""
    return latest_per_key(without_payload(mapped), "job_id", silver_order())


def upsert_rows(current: DataFrame, batch: DataFrame, key: str = "job_id") -> DataFrame:
    """S8 core: ``batch`` UNION (``current`` rows whose key is not in ``batch``).

    A matched row is replaced as a whole; nothing is deleted.  ``batch`` must
    hold one row per key (W1 guarantees it for Silver).
    """
    return batch.unionByName(current.join(batch.select(key), key, "left_anti"))


# What W1 orders by beside the publication date, kept with every Silver row.
ORDER = StructType(
    [
        StructField("_ingestion_date", DateType()),
        StructField("_fetched_at", TimestampType()),
        StructField("_payload_h1", LongType()),
        StructField("_payload_h2", IntegerType()),
    ]
)
ORDER_COLUMNS = [f.name for f in ORDER.fields]


def order_columns() -> list[Column]:
    """:data:`ORDER_COLUMNS` of normalised rows with payload hashes."""
    return [F.col("ingestion_date").alias("_ingestion_date"), F.col("fetched_at").alias("_fetched_at"), F.col("_payload_h1"), F.col("_payload_h2")]


def newer_than_current(batch: DataFrame, current: DataFrame, key: str = "job_id", order_col: str = "publication_date") -> DataFrame:
    """Batch rows that win against the current row of their key.

    Where both sides have :data:`ORDER_COLUMNS`, rows are compared by W1's whole
    order, so a batch of any date, also an old one that arrives late, gives what
    a full recompute would give.  Where they are missing, or null (rows stored
    before they were kept), the batch counts as later than the current row: it
    wins unless the current row has a strictly newer ``order_col`` (or the batch
    row has none while the current row has one).  The anti join reads
    ``current`` once; AQE broadcasts the batch side when it is small.
    """
    known = [c for c in ORDER_COLUMNS if c in batch.columns and c in current.columns]
    b, c = batch.alias("_b"), current.select(key, order_col, *known).alias("_c")
    bo, co = F.col(f"_b.{order_col}"), F.col(f"_c.{order_col}")
    current_wins = co.isNotNull() & (bo.isNull() | (co > bo))
    if len(known) == len(ORDER_COLUMNS):
        mine, theirs = (F.struct(*[F.col(f"{side}.{n}").alias(n) for n in known]) for side in ("_b", "_c"))
        current_wins = current_wins | (bo.eqNullSafe(co) & F.col("_c._ingestion_date").isNotNull() & (theirs > mine))
    return b.join(c, (F.col(f"_b.{key}") == F.col(f"_c.{key}")) & current_wins, "left_anti")
