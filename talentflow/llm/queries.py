"""The ``opN_*`` queries: each applies one operator, with its production
parameters, to the whole of its table and derives the contract's columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, centroids, conversations, countmin, decontaminate, exact_dedup, fingerprints, language, ngram_join, quality, secrets, suffix_array, toxicity
from .common import crc_mod, read_table


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.dedup_report(read_table(spark, sf_dir, "documents"))


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaked_pairs(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op3_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_array.remove_repeats(read_table(spark, sf_dir, "documents"), texts=False)


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learns from documents whose crc32(doc_id) mod 3 is not 1."""
    docs = read_table(spark, sf_dir, "documents")
    held_out = crc_mod("doc_id", 3) == 1
    labels = docs.filter(~held_out & F.col("lang").isNotNull()).select("doc_id", F.col("lang").alias("label"))
    model = language.fit(docs, labels)
    return language.predict(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def training_labels(spark: SparkSession, sf_dir: str, label: str) -> DataFrame:
    """doc_id, label of the labelled documents outside the held-out fold."""
    labels = read_table(spark, sf_dir, "labels").filter((crc_mod("doc_id", 5) != 0) & F.col(label).isNotNull())
    return labels.groupBy("doc_id").agg(F.max(label).alias("label"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    scored = quality.predict(docs, quality.fit(docs, training_labels(spark, sf_dir, "quality")))
    return scored.select("doc_id", (crc_mod("doc_id", 5) == 0).alias("held_out"), "score", "predicted")


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    scored = toxicity.predict(docs, toxicity.fit(docs, training_labels(spark, sf_dir, "toxic")))
    return scored.select("doc_id", (crc_mod("doc_id", 5) == 0).alias("held_out"), "score", "predicted")


def op7_countmin_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return countmin.remove_repeats(read_table(spark, sf_dir, "documents"), texts=False)


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_report(read_table(spark, sf_dir, "documents"))


def op9_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(read_table(spark, sf_dir, "documents"))


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_documents(read_table(spark, sf_dir, "documents"), ids=False)


def op11_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repair_report(read_table(spark, sf_dir, "conversations"))


def op12_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_report(read_table(spark, sf_dir, "documents"))


def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster_vectors(read_table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_decontaminate": op2_decontaminate,
    "op3_suffix_array": op3_suffix_array,
    "op4_language": op4_language,
    "op5_quality": op5_quality,
    "op6_toxicity": op6_toxicity,
    "op7_countmin_substrings": op7_countmin_substrings,
    "op8_secrets": op8_secrets,
    "op9_ngram_join": op9_ngram_join,
    "op10_byte_bpe": op10_byte_bpe,
    "op11_conversations": op11_conversations,
    "op12_fingerprints": op12_fingerprints,
    "op13_centroids": op13_centroids,
}

ORACLES: dict[str, str] = {
    "op1_exact_dedup": exact_dedup.ORACLE,
    "op7_countmin_substrings": countmin.ORACLE,
    "op8_secrets": secrets.oracle(),
    "op11_conversations": conversations.ORACLE,
    "op12_fingerprints": fingerprints.ORACLE,
    "op13_centroids": centroids.ORACLE,
}
