"""Registered queries: one per operator family, each reading the supplied
tables at ``sf_dir`` in full.  Arrays are rendered with ``array_join(x, '|')``
and timestamps as epoch microseconds, so results compare as plain values with
the SQL oracles in :mod:`talentflow.plans.oracles`."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import BRONZE_COLUMNS
from ..functions.terms import extract_terms, required_years
from ..functions.text import strip_html
from ..operators import presence, views
from ..operators.latest import latest_per_key, upsert_rows
from ..operators.matching import Profile, match_profile_table, match_scores, profiles_from_text
from ..operators.normalize import normalize
from ..operators.term_lookup import catalog_trends, with_terms
from ..session import scratch_path
from ..sources import landing, tables
from . import derived, gold, jobs, oracles
from .derived import part_postings, table
from .silver import enrich_with_technologies, latest_silver, silver_batch, transform

# Three literal candidate profiles for the flagship query.
FLAGSHIP_PROFILES = [
    Profile(
        frozenset({"Azure", "Azure Data Factory", "Databricks", "Git", "Power BI", "SQL", "SQL Server", "Spark"}),
        frozenset({"Agile", "ETL/ELT", "Stakeholder Management", "Incremental Loads", "Metadata-driven", "DevOps"}),
        5.0,
        "data-engineer",
    ),
    Profile(
        frozenset({"Kubernetes", "Docker", "Terraform", "AWS", "Python", "Kafka"}),
        frozenset({"DevOps", "CI/CD", "Mentoring"}),
        8.5,
        "platform",
    ),
    Profile(frozenset({"Python", "SQL"}), frozenset(), 2.5, "junior"),
]

# Batch dates used by the Bronze-history queries (events span 2024-01-01..30).
PREVIOUS_DAY = dt.date(2024, 1, 14)
CURRENT_DAY = dt.date(2024, 1, 15)
CHANGE_DAYS = (dt.date(2024, 1, 5), dt.date(2024, 1, 20))
# All history, split at one date.
TARGET_DAYS = (dt.date(1900, 1, 1), dt.date(2024, 1, 15))
BATCH_DAYS = (dt.date(2024, 1, 16), dt.date(2999, 12, 31))
FIRST_BATCH = dt.date(2024, 5, 1)
SECOND_BATCH = dt.date(2024, 5, 2)


def _flat(df: DataFrame, *array_cols: str) -> DataFrame:
    return df.select(*[F.array_join(c, "|").alias(c) if c in array_cols else F.col(c) for c in df.columns])


# ------------------------------------------------------------- matching --

def q_match_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P4 (+F9-F16, P1): part-built postings x three literal profiles."""
    postings = part_postings(spark, sf_dir)
    scored = match_scores(postings, FLAGSHIP_PROFILES)
    return _flat(scored, "matched_skills", "missing_skills", "matched_keywords")


TOP_K = 25


def q_match_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P4 + O2 top-k: the best 25 postings per profile (per-profile
    row_number, planned as a WindowGroupLimit before the shuffle)."""
    postings = part_postings(spark, sf_dir)
    scored = match_scores(postings, FLAGSHIP_PROFILES, ordered=True, top_k=TOP_K)
    return _flat(scored, "matched_skills", "missing_skills", "matched_keywords")


PROFILE_TOP_K = 3


def q_match_profiles_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best postings of every profile of a profile table
    (one per conversation turn), with their rank."""
    postings = part_postings(spark, sf_dir)
    profiles = profiles_from_text(derived.cv_texts_from_conversations(spark, sf_dir))
    best = match_profile_table(postings, profiles, PROFILE_TOP_K)
    return _flat(best.select("profile_id", "job_id", "match_score", "matched_skills", "rank"), "matched_skills")


def q_profiles_from_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A profile from every conversation turn's text."""
    p = profiles_from_text(derived.cv_texts_from_conversations(spark, sf_dir))
    return _flat(p, "technologies", "keywords")


# ----------------------------------------------------------- extraction --

def q_tech_trends(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2 + P1 + F10: technology mentions over part-built postings."""
    return views.tech_trends(part_postings(spark, sf_dir))


def q_extract_terms_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F9 with a caller catalog over whole multilingual documents."""
    d = table(spark, sf_dir, "documents")
    return _flat(d.select("doc_id", extract_terms(F.col("text"), derived.DOCUMENT_CATALOG).alias("terms")), "terms")


def q_term_trends_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2 with a caller catalog: mentions per term over whole documents."""
    s = derived.silver_from_documents(spark, sf_dir)
    return views.tech_trends(enrich_with_technologies(s, derived.DOCUMENT_CATALOG))


def q_large_catalog_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F9 with a catalog table of thousands of names over whole documents."""
    catalog = derived.catalog_from_benchmark(spark, sf_dir)
    d = with_terms(table(spark, sf_dir, "documents").select("doc_id", "text"), "text", catalog)
    names = F.array_join("terms", "|")
    return d.select("doc_id", F.size("terms").cast("long").alias("n_terms"), F.sha2(names, 256).alias("terms_sha256"))


def q_large_catalog_trends(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2 with the same catalog: documents per mentioned name."""
    catalog = derived.catalog_from_benchmark(spark, sf_dir)
    return catalog_trends(table(spark, sf_dir, "documents"), "doc_id", "text", catalog)


def q_required_years_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F11 over each whole document followed by a years sentence."""
    d = table(spark, sf_dir, "documents")
    text = F.concat_ws(" ", F.col("text"), derived.years_phrase((F.col("doc_id") % 50).cast("int")))
    return d.select("doc_id", required_years(text).alias("required_years"))


def q_strip_html_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F1 over every raw page."""
    p = table(spark, sf_dir, "pages")
    return p.select("page_id", strip_html(F.col("html")).alias("text"))


# -------------------------------------------------------- normalisation --

def _normalized(spark: SparkSession, sf_dir: str, source: str) -> DataFrame:
    bronze = derived.bronze_from_payloads(spark, sf_dir, FIRST_BATCH).filter(F.col("source") == source)
    m = normalize(bronze)
    ok = F.col("reject_reason").isNull()
    keep = ["company", "title", "location", "remote", "description", "source", "link"]
    return m.select(
        "job_id",
        *[F.when(ok, F.col(c)).alias(c) for c in keep],
        F.when(ok, F.unix_micros("publication_date")).alias("publication_us"),
        "reject_reason",
    )


def q_normalize_board_a(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Board-A payloads -> Silver or reject."""
    return _normalized(spark, sf_dir, "greenhouse")


def q_normalize_board_b(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Board-B payloads -> Silver or reject."""
    return _normalized(spark, sf_dir, "smartrecruiters")


def _silver_out(s: DataFrame) -> DataFrame:
    return _flat(
        s.select(
            "job_id", "company", "title", "location", "remote", "description", "technologies", "source",
            F.unix_micros("publication_date").alias("publication_us"), "link",
        ),
        "technologies",
    )


def q_silver_transform(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P2 (N1-N10, W1, P1): two Bronze batches -> current Silver rows."""
    bronze = derived.bronze_batches(spark, sf_dir, [(FIRST_BATCH, 0), (SECOND_BATCH, 1)])
    silver, _rejects = silver_batch(bronze, on_error="quarantine")
    return _silver_out(silver)


def q_silver_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P2 incremental (S5-S8 with W1's order) through the job itself: the newer
    batch is merged first, then the older one arrives late under its own date;
    equals the full recompute."""
    bronze, silver, rejects = (scratch_path(spark, "incremental", uuid.uuid4().hex, t) for t in ("bronze", "silver", "rejects"))
    for day, revision in ((SECOND_BATCH, 1), (FIRST_BATCH, 0)):
        rows = derived.bronze_from_payloads(spark, sf_dir, day, revision=revision)
        tables.append_bronze(rows, bronze, f"revision-{revision}")
        jobs.bronze_to_silver(spark, bronze, silver, rejects_path=rejects)
    return _silver_out(tables.read_silver(spark, silver))


# --------------------------------------------------------------- landing --

def _postings_out(rows: DataFrame) -> DataFrame:
    pv = F.try_parse_json(F.col("raw_payload"))
    title = F.coalesce(F.try_variant_get(pv, "$.title", "string"), F.try_variant_get(pv, "$.name", "string"))
    return rows.select("source", "source_job_id", "company_identifier", "url", title.alias("payload_title"))


def q_explode_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paged provider responses -> one row per posting."""
    rows, _rejects = landing.explode_responses(derived.responses_from_payloads(spark, sf_dir))
    return _postings_out(rows)


def q_target_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3 (+S1, S2): only responses of non-excluded targets are exploded."""
    # the target list has one row per (source, nation): a fixed 50-row dimension
    gated = landing.gate_targets(
        derived.responses_from_payloads(spark, sf_dir), derived.targets_from_nation(spark, sf_dir), broadcast_ok=True
    )
    rows, _rejects = landing.explode_responses(gated)
    return _postings_out(rows)


def q_bronze_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze rows in schema order (timestamps as text)."""
    b = derived.bronze_from_events(spark, sf_dir).select(*BRONZE_COLUMNS)
    return b.select(
        F.concat_ws(":", "source", "source_job_id").alias("job_id"),
        *[F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(c) if c == "fetched_at" else F.col(c) for c in b.columns],
    )


# ---------------------------------------------------------------- history --

def q_new_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys in the current batch but not the previous one."""
    return views.new_postings(derived.bronze_from_events(spark, sf_dir), PREVIOUS_DAY, CURRENT_DAY)


def q_removed_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys in the previous batch but not the current one."""
    return views.removed_postings(derived.bronze_from_events(spark, sf_dir), PREVIOUS_DAY, CURRENT_DAY)


def q_removed_postings_fetched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X2 option: only (source, company) pairs fetched in both batches (here
    forty user groups per event type, some of them absent on either day)."""
    bronze = derived.bronze_from_events(spark, sf_dir)
    group = F.concat_ws("-", "source", (F.col("source_job_id").cast("long") % 40).cast("string"))
    return views.removed_postings(bronze.withColumn("company_identifier", group), PREVIOUS_DAY, CURRENT_DAY, only_fetched_targets=True)


def q_removed_postings_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1, S2, S4, X2 with evidence: landed pages of two days, of which the later
    lacks some, has empty ones and broken ones; only targets that were fetched
    completely report removals."""
    batches = [
        (day, landing.explode_all(derived.responses_from_events(spark, sf_dir, day, damaged=day == CURRENT_DAY), keep_empty=True))
        for day in (PREVIOUS_DAY, CURRENT_DAY)
    ]
    before, now = (landing.to_bronze(rows.filter("reject_reason is null"), day) for day, rows in batches)
    fetches = landing.fetch_outcomes(batches[1][1], CURRENT_DAY)
    return presence.removed_with_evidence(before.unionByName(now), fetches, PREVIOUS_DAY, CURRENT_DAY)


def q_posting_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X0-X2 over all batches: when every key was there."""
    return presence.presence_intervals(derived.bronze_from_events(spark, sf_dir))


def q_posting_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X1, X2 over all event days: new, returned, removed and open keys a day."""
    return presence.activity_by_day(q_posting_intervals(spark, sf_dir))


def q_posting_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X1, X2 between two days far apart, from the intervals."""
    return presence.changes_between(q_posting_intervals(spark, sf_dir), *CHANGE_DAYS)


def _events_latest(spark: SparkSession, sf_dir: str, days=None) -> DataFrame:
    b = derived.bronze_from_events(spark, sf_dir)
    if days is not None:
        b = b.filter(F.col("ingestion_date").between(F.lit(days[0]), F.lit(days[1])))
    keyed = b.select(
        F.concat_ws(":", "source", "source_job_id").alias("job_id"), "event_id", "value", "fetched_at", "ingestion_date",
        F.xxhash64("raw_payload").alias("_payload_h1"),
    )
    order = [F.col("fetched_at").desc_nulls_last(), F.col("ingestion_date").desc(), F.col("_payload_h1").desc()]
    return latest_per_key(keyed, "job_id", order)


def q_latest_per_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Newest row per key over the whole event history."""
    return _events_latest(spark, sf_dir).select("job_id", "event_id", "value")


def q_silver_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The later half of all history upserted into the earlier half."""
    target = _events_latest(spark, sf_dir, TARGET_DAYS)
    batch = _events_latest(spark, sf_dir, BATCH_DAYS)
    return upsert_rows(target, batch, "job_id").select("job_id", "event_id", "ingestion_date")


# ------------------------------------------------------------------- gold --

def q_active_companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1, O1: per company (= language) postings and distinct sources."""
    return views.active_companies(derived.silver_from_documents(spark, sf_dir))


def q_duplicate_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Same company and normalised title (the whole text)."""
    return views.duplicate_postings(derived.silver_from_documents(spark, sf_dir))


def q_duplicate_postings_cross_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W2 option: duplicates that span at least two sources."""
    return views.duplicate_postings(derived.silver_from_documents(spark, sf_dir), cross_source_only=True)


def q_active_companies_open(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1 option: current postings per company, without the postings that
    disappeared between the two newest batches (X2)."""
    current = _events_latest(spark, sf_dir).select(
        "job_id", F.split("job_id", ":").getItem(0).alias("company"), (F.col("event_id") % 4).cast("string").alias("source")
    )
    bronze = derived.bronze_from_events(spark, sf_dir)
    days = [r[0] for r in bronze.select("ingestion_date").distinct().orderBy(F.desc("ingestion_date")).limit(2).collect()]
    if len(days) < 2:
        return views.active_companies(current)
    removed = views.removed_postings(bronze, days[1], days[0])
    return views.active_companies(current, removed=removed)


def q_pipeline_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S5-S9, A4, P2 end to end on files: two Bronze appends, two Silver
    upserts, then the active-companies view written as a Gold snapshot and
    read back.  Files go to the shared checkpoint folder."""
    base = scratch_path(spark, "pipeline", uuid.uuid4().hex)
    bronze_path, silver_path, gold_path = f"{base}/bronze", f"{base}/silver", f"{base}/gold"
    for day, rev in ((FIRST_BATCH, 0), (SECOND_BATCH, 1)):
        tables.append_bronze(derived.bronze_from_payloads(spark, sf_dir, day, revision=rev), bronze_path)
        transform(spark, bronze_path, silver_path, on_error="quarantine", rejects_path=f"{base}/rejects")
    silver = tables.read_silver(spark, silver_path)
    tables.write_snapshot(views.active_companies(silver, ordered=False), gold_path)
    return tables.read_snapshot(spark, gold_path)


def q_gold_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two batches upserted, the second replacing rows of the first;
    the companies come from counts that signed changes have updated."""
    base = scratch_path(spark, "counts", uuid.uuid4().hex)
    silver_path, gold_root = f"{base}/silver", f"{base}/gold"
    for day, rev in ((FIRST_BATCH, 0), (SECOND_BATCH, 1)):
        bronze = derived.bronze_from_payloads(spark, sf_dir, day, revision=rev)
        rows, _ = latest_silver(normalize(bronze), "quarantine")
        gold.upsert_and_count(rows, silver_path, gold_root)
    return gold.active_companies(spark, silver_path, gold_root)


def q_landing_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1-S5 as Structured Streaming: derived responses are landed as JSON
    Lines files, one stream run (availableNow) gates, explodes and appends
    them to Bronze, and the Bronze table is read back."""
    from ..streaming import start_landing_stream

    base = scratch_path(spark, "stream", uuid.uuid4().hex)
    landed = derived.responses_from_payloads(spark, sf_dir)
    landed.select("source", "company_identifier", "body").write.partitionBy("source", "company_identifier").text(f"{base}/landing")
    q = start_landing_stream(
        spark, f"{base}/landing", f"{base}/bronze", f"{base}/rejects", f"{base}/checkpoint",
        targets=derived.targets_from_nation(spark, sf_dir), ingestion_date=FIRST_BATCH, per_line=True,
    )
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return _postings_out(tables.read_bronze(spark, f"{base}/bronze"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "match_scores": q_match_scores,
    "match_top_k": q_match_top_k,
    "match_profiles_top_k": q_match_profiles_top_k,
    "profiles_from_text": q_profiles_from_text,
    "tech_trends": q_tech_trends,
    "extract_terms_documents": q_extract_terms_documents,
    "term_trends_documents": q_term_trends_documents,
    "large_catalog_documents": q_large_catalog_documents,
    "large_catalog_trends": q_large_catalog_trends,
    "required_years_documents": q_required_years_documents,
    "strip_html_pages": q_strip_html_pages,
    "normalize_board_a": q_normalize_board_a,
    "normalize_board_b": q_normalize_board_b,
    "silver_transform": q_silver_transform,
    "silver_incremental": q_silver_incremental,
    "explode_responses": q_explode_responses,
    "target_gate": q_target_gate,
    "bronze_from_events": q_bronze_from_events,
    "new_postings": q_new_postings,
    "removed_postings": q_removed_postings,
    "removed_postings_fetched": q_removed_postings_fetched,
    "removed_postings_evidence": q_removed_postings_evidence,
    "posting_intervals": q_posting_intervals,
    "posting_activity": q_posting_activity,
    "posting_changes": q_posting_changes,
    "latest_per_job": q_latest_per_job,
    "silver_upsert": q_silver_upsert,
    "active_companies": q_active_companies,
    "active_companies_open": q_active_companies_open,
    "duplicate_postings": q_duplicate_postings,
    "duplicate_postings_cross_source": q_duplicate_postings_cross_source,
    "pipeline_roundtrip": q_pipeline_roundtrip,
    "gold_incremental": q_gold_incremental,
    "landing_stream": q_landing_stream,
}

ORACLES: dict[str, str] = oracles.build_all(
    top_k=TOP_K,
    profile_top_k=PROFILE_TOP_K,
    profiles=FLAGSHIP_PROFILES,
    previous_day=PREVIOUS_DAY,
    current_day=CURRENT_DAY,
    change_days=CHANGE_DAYS,
    target_days=TARGET_DAYS,
    batch_days=BATCH_DAYS,
    first_batch=FIRST_BATCH,
    second_batch=SECOND_BATCH,
)
