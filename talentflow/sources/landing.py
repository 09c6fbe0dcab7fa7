"""Landed provider responses -> Bronze rows.

A landed response is one JSON document per fetch (a provider page, bounded by
the provider's page size).  Responses are gated by the target list first, then
exploded into one row per posting; each posting keeps its own JSON text as the
raw payload (the array is read as ``array<string>``, which returns every
element's original text, key order and number spelling included).
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.json import is_object_text, python_str, read_object
from ..schemas import BRONZE_COLUMNS, TARGETS


@dataclass(frozen=True)
class ResponseShape:
    """Where a provider's response keeps its postings.

    ``list_keys``: candidate keys of the postings array; the first key present
    in the response is used (present-but-null is an error), none present means
    no postings.  ``url_keys``: candidate keys of the posting URL; the first
    present key's value is used, ``''`` when none is present.
    """

    list_keys: tuple[str, ...]
    url_keys: tuple[str, ...]
    id_key: str = "id"


# Source name -> response shape.  Adding a source means adding one entry.
SHAPES: dict[str, ResponseShape] = {
    "greenhouse": ResponseShape(("jobs",), ("absolute_url",)),
    "smartrecruiters": ResponseShape(("content", "postings"), ("applyUrl", "jobAdUrl")),
}

# Upper bound on a target list that is shipped to every task (~100 bytes a row).
MAX_BROADCAST_TARGETS = 100_000


LANDED_SCHEMA = "value string, source string, company_identifier string"


def read_landed(spark: SparkSession, root: str, paths: Sequence[str] | None = None) -> DataFrame:
    """Landed files laid out as ``root/source=<s>/company_identifier=<c>/*.json``;
    with ``paths`` only these files of ``root``.

    Returns ``source, company_identifier, fetched_at, body, file``; ``fetched_at``
    is the file's modification time.  One file is one response.  The schema is
    declared, so identifiers in directory names stay strings (``007``).
    """
    files = spark.read.format("text").option("wholetext", True).schema(LANDED_SCHEMA)
    if paths is None:
        rows = files.load(root)
    elif paths:  # names are no patterns
        rows = files.option("basePath", root).load([re.sub(r"([\\{}\[\]*?])", r"\\\1", p) for p in paths])
    else:
        rows = files.load(root).filter("false")
    return (
        rows.select(
            "source",
            "company_identifier",
            F.col("_metadata.file_modification_time").alias("fetched_at"),
            F.col("value").alias("body"),
            F.col("_metadata.file_path").alias("file"),
        )
    )


def targets_frame(spark: SparkSession, targets: Iterable[tuple[str, str, str]]) -> DataFrame:
    rows = list(targets)
    return spark.createDataFrame(rows, TARGETS)


def gate_targets(responses: DataFrame, targets: DataFrame, broadcast_ok: bool | None = None) -> DataFrame:
    """S3: keep responses whose (source, company) target is not excluded.

    The target list is a configuration dimension.  ``broadcast_ok=True``: the
    caller vouches for its size and it is broadcast; ``None`` (default): it is
    counted and broadcast only when it has at most ``MAX_BROADCAST_TARGETS``
    rows; ``False`` or a larger list: AQE chooses from measured sizes.
    """
    active = targets.filter(F.col("risk_tier") != "excluded").select("source", "company_identifier")
    if broadcast_ok is None:
        broadcast_ok = active.limit(MAX_BROADCAST_TARGETS + 1).count() <= MAX_BROADCAST_TARGETS
    if broadcast_ok:
        active = F.broadcast(active)
    return responses.join(active, ["source", "company_identifier"], "left_semi")


def _first(flags: Sequence[Column]) -> Column:
    """Index (0-based) of the first true flag; NULL if none."""
    out = F.lit(None).cast("int")
    for i, flag in reversed(list(enumerate(flags))):
        out = F.when(flag, F.lit(i)).otherwise(out)
    return out


def _pick(index: Column, values: Sequence[Column], otherwise: Column) -> Column:
    out = otherwise
    for i, value in enumerate(values):
        out = F.when(index == i, value).otherwise(out)
    return out


def explode_responses(responses: DataFrame, shapes: Mapping[str, ResponseShape] | None = None) -> tuple[DataFrame, DataFrame]:
    """One row per posting; returns (postings, rejected responses).

    Postings: ``source, source_job_id, company_identifier, fetched_at, url,
    raw_payload``.  A response is rejected (with a reason) when its source has
    no shape, its text is not one JSON object, or the chosen array key holds null
    or something other than an array; a posting is rejected, alone, when it is
    not an object or has no id.  An id is spelled as Python's ``str`` spells it.  Both outputs come
    from :func:`explode_all`; a job that writes both should materialise that
    once (see ``plans.jobs.land_to_bronze``).
    """
    out = explode_all(responses, shapes)
    ok = F.col("reject_reason").isNull()
    return out.filter(ok).drop("reject_reason"), out.filter(~ok).select(*REJECT_COLUMNS)


REJECT_COLUMNS = ["source", "company_identifier", "fetched_at", "reject_reason"]


NO_POSTINGS = "no_postings"
POSTING_WITHOUT_ID = "posting_without_id"


def explode_all(responses: DataFrame, shapes: Mapping[str, ResponseShape] | None = None, keep_empty: bool = False) -> DataFrame:
    """Postings and rejects in one frame: ``source, source_job_id,
    company_identifier, fetched_at, url, raw_payload, reject_reason`` (NULL for
    a good posting; a rejected response gives one row with its reason).  With
    ``keep_empty`` an accepted response without postings gives one row, whose
    reason is ``NO_POSTINGS``: evidence of a fetch, no reject."""
    shp = dict(SHAPES if shapes is None else shapes)
    src, body = F.col("source"), F.col("body")

    def by_source(fn) -> Column:
        out = None
        for name, s in shp.items():
            e = fn(s)
            out = F.when(src == name, e) if out is None else out.when(src == name, e)
        return out

    # A page is read by key, never as one VARIANT value, so its size is free:
    # once as text (to tell null from a value), once as array of element texts.
    list_keys = sorted({k for s in shp.values() for k in s.list_keys})
    pages = responses.select(
        "source",
        "company_identifier",
        "fetched_at",
        "body",
        read_object(body, {k: "string" for k in list_keys}).alias("_text"),
        read_object(body, {k: "array<string>" for k in list_keys}).alias("_list"),
        F.json_object_keys(body).alias("_keys"),
    )

    def chosen(s: ResponseShape) -> Column:
        return _first([F.array_contains("_keys", k) for k in s.list_keys])

    staged = pages.select(
        *[c for c in pages.columns if c not in ("_text", "_list", "_keys", "body")],
        F.col("_text").isNotNull().alias("_object"),
        (~is_object_text(body) & F.try_parse_json(body).isNotNull()).alias("_other"),
        by_source(lambda s: _pick(chosen(s), [F.col(f"_list.{k}") for k in s.list_keys], F.array().cast("array<string>"))).alias("_elems"),
        by_source(lambda s: _pick(chosen(s), [F.col(f"_text.{k}").isNull() for k in s.list_keys], F.lit(False))).alias("_null_list"),
    )
    reason = (
        F.when(~src.isin(*shp), F.lit("unknown_source"))
        .when(~F.col("_object"), F.when(F.col("_other"), F.lit("response_not_object")).otherwise(F.lit("malformed_json")))
        .when(F.col("_null_list"), F.lit("null_postings_list"))
        .when(F.col("_elems").isNull(), F.lit("bad_postings_list"))
    )
    staged = staged.withColumn("_reason", reason)
    # outer explode: a rejected response keeps one row (for its reason); an
    # accepted response with no postings yields none (its position is NULL)
    posts = staged.select(
        "source", "company_identifier", "fetched_at", "_reason",
        F.posexplode_outer(F.when(F.col("_reason").isNull(), F.col("_elems"))).alias("_pos", "raw_payload"),
    )
    if keep_empty:
        posts = posts.withColumn("_reason", F.coalesce("_reason", F.when(F.col("_pos").isNull(), F.lit(NO_POSTINGS))))
    else:
        posts = posts.filter(F.col("_reason").isNotNull() | F.col("_pos").isNotNull())
    scalars = sorted({k for s in shp.values() for k in (s.id_key, *s.url_keys)})
    posts = posts.withColumn("_p", read_object(F.col("raw_payload"), {k: "variant" for k in scalars}))

    def url_of(s: ResponseShape) -> Column:
        values = [F.col(f"_p.{k}") for k in s.url_keys]
        texts = [F.try_variant_get(v, "$", "string") for v in values]
        return _pick(_first([v.isNotNull() for v in values]), texts, F.lit(""))

    with_ids = posts.select(
        "source",
        by_source(lambda s: python_str(F.col(f"_p.{s.id_key}"))).alias("source_job_id"),
        "company_identifier",
        "fetched_at",
        by_source(url_of).alias("url"),
        "raw_payload",
        "_reason",
    )
    reject = F.coalesce(F.col("_reason"), F.when(F.col("source_job_id").isNull(), F.lit(POSTING_WITHOUT_ID)))
    return with_ids.select(
        *[F.when(reject.isNull(), F.col(c)).alias(c) if c in ("source_job_id", "url", "raw_payload") else F.col(c)
          for c in ("source", "source_job_id", "company_identifier", "fetched_at", "url", "raw_payload")],
        reject.alias("reject_reason"),
    )


def fetch_outcomes(rows: DataFrame, ingestion_date: dt.date) -> DataFrame:
    """What was fetched of every target: ``source, company_identifier,
    ingestion_date, failed_responses, postings, complete``.

    ``rows`` come from :func:`explode_all` with ``keep_empty``.  A target without
    any response has no row; one is ``complete`` when none of its responses was
    rejected, however many postings they held (a single posting without an id
    does not count against its target).  One partial aggregate per target.
    """
    reason = F.col("reject_reason")
    failed = F.count_if(reason.isNotNull() & ~reason.isin(NO_POSTINGS, POSTING_WITHOUT_ID))
    return rows.groupBy("source", "company_identifier").agg(failed.alias("failed_responses"), F.count_if(reason.isNull()).alias("postings")).select(
        "source",
        "company_identifier",
        F.lit(ingestion_date).cast("date").alias("ingestion_date"),
        "failed_responses",
        "postings",
        (F.col("failed_responses") == 0).alias("complete"),
    )


def to_bronze(postings: DataFrame, ingestion_date: dt.date | None = None) -> DataFrame:
    """Stamp the batch date (default: today in UTC) and order the columns."""
    d = ingestion_date or dt.datetime.now(dt.timezone.utc).date()
    return postings.select(
        "source",
        "source_job_id",
        "company_identifier",
        F.col("fetched_at").cast("timestamp").alias("fetched_at"),
        "url",
        "raw_payload",
        F.lit(d).cast("date").alias("ingestion_date"),
    ).select(*BRONZE_COLUMNS)
