"""The corpus pipeline: whole-table stages, each one of the llm operators.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; ``run``
writes each result as Parquet in the shared folder and reads it again as the
next stage's documents.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from talentflow.llm import bpe, decontaminate, ngram_join, quality
from talentflow.llm.common import read_table
from talentflow.llm.exact_dedup import exact_dedup
from talentflow.llm.queries import training_labels
from talentflow.session import scratch_path


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: documents the line field rejects go.  It is trained on the
    labelled rows of the original tables."""
    originals = read_table(spark, sf_dir, "documents")
    return quality.keep_good(docs, quality.fit(originals, training_labels(spark, sf_dir, "quality")))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: of equal texts one document stays."""
    return exact_dedup(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: of every group of near-duplicates one document stays."""
    return ngram_join.drop_near_duplicates(docs)


def drop_leaked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: documents with a passage of the benchmark go."""
    return decontaminate.drop_leaked(docs, read_table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: token ids of every document that is left."""
    return bpe.encode_documents(docs)


STAGES = [
    ("quality", keep_good),
    ("exact_dedup", drop_copies),
    ("ngram_join", drop_near_copies),
    ("decontaminate", drop_leaked),
    ("byte_bpe", encode),
]

# Trained models and edit distances have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    folder = scratch_path(spark, f"corpus-{uuid.uuid4().hex}")
    for k, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{k}_{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
