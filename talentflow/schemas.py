"""Explicit table schemas (no inference anywhere)."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DateType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# --- Fixed values: the column contracts of the Bronze and Silver tables. -----
BRONZE = StructType(
    [
        StructField("source", StringType(), nullable=False),
        StructField("source_job_id", StringType(), nullable=False),
        StructField("company_identifier", StringType(), nullable=False),
        StructField("fetched_at", TimestampType(), nullable=False),
        StructField("url", StringType(), nullable=True),
        StructField("raw_payload", StringType(), nullable=False),
        StructField("ingestion_date", DateType(), nullable=False),
    ]
)

SILVER = StructType(
    [
        StructField("job_id", StringType(), nullable=False),
        StructField("company", StringType(), nullable=False),
        StructField("title", StringType(), nullable=False),
        StructField("location", StringType(), nullable=True),
        StructField("remote", BooleanType(), nullable=True),
        StructField("salary", StringType(), nullable=True),
        StructField("description", StringType(), nullable=True),
        StructField("technologies", ArrayType(StringType()), nullable=True),
        StructField("source", StringType(), nullable=False),
        StructField("publication_date", TimestampType(), nullable=True),
        StructField("link", StringType(), nullable=True),
    ]
)

TARGETS = StructType(
    [
        StructField("source", StringType(), nullable=False),
        StructField("company_identifier", StringType(), nullable=False),
        StructField("risk_tier", StringType(), nullable=False),
    ]
)

SILVER_COLUMNS = [f.name for f in SILVER.fields]
BRONZE_COLUMNS = [f.name for f in BRONZE.fields]
