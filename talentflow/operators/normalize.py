"""Bronze -> Silver normalisation.

Each source registers a *mapping*: the JSON paths it reads, and a function
from those fields (and the Bronze ``url``) to the Silver columns plus the
conditions under which the upstream per-row mapper would have failed.

The plan has three narrow projections: (1) parse the payload once and pull
every registered path out as a VARIANT column, (2) derive each field's type
name, string value and truthiness once, (3) evaluate the mappings, switched
by ``source`` with CASE.  Bronze is scanned once, whatever the number of
sources, and each projection stays small enough for whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.json import is_object_text, read_object, truthy, vtype
from ..functions.memo import per_context
from ..functions.text import falsy_fallback, format_location, looks_remote, parse_iso_timestamp, strip_html
from ..schemas import SILVER_COLUMNS


@dataclass(frozen=True)
class Mapped:
    """One source's raw Silver pieces and a reject reason (NULL when the row
    maps cleanly).  Shared steps run once after the per-source switch:
    ``publication_text`` is parsed as ISO-8601, and ``remote`` is
    ``remote_flag OR looks_remote(location, title, description)``."""

    title: Column
    location: Column
    description: Column
    publication_text: Column
    link: Column
    remote_flag: Column
    reject: Column


class Fields:
    """Access to the precomputed columns of one source's JSON fields."""

    def __init__(self, prefix: str) -> None:
        self.prefix = prefix

    def col(self, name: str, part: str) -> Column:
        return F.col(f"{self.prefix}{name}__{part}")

    def v(self, n: str) -> Column:  # the VARIANT value (NULL when absent)
        return self.col(n, "v")

    def t(self, n: str) -> Column:  # its type name ('VOID' for JSON null)
        return self.col(n, "t")

    def s(self, n: str) -> Column:  # its string value
        return self.col(n, "s")

    def truthy(self, n: str) -> Column:
        return self.col(n, "b")

    def present(self, n: str) -> Column:
        return self.v(n).isNotNull()

    def is_null(self, n: str) -> Column:
        return self.present(n) & (self.t(n) == "VOID")

    def is_object(self, n: str) -> Column:
        return self.t(n).startswith("OBJECT")

    def not_string(self, n: str) -> Column:
        """Present, not JSON null, and not a string."""
        return self.present(n) & (self.t(n) != "VOID") & (self.t(n) != "STRING")


@dataclass(frozen=True, eq=False)
class SourceMapping:
    fields: Mapping[str, str]  # field name -> JSON path
    build: Callable[[Fields, Column], Mapped]


def _first_reason(*pairs: tuple[Column, str]) -> Column:
    out = F.lit(None).cast("string")
    for cond, reason in reversed(pairs):
        out = F.when(cond, F.lit(reason)).otherwise(out)
    return out


def _title(f: Fields, n: str) -> tuple[Column, list[tuple[Column, str]]]:
    """Absent -> ''; JSON null and non-strings fail the row."""
    value = F.when(~f.present(n), F.lit("")).otherwise(f.s(n))
    return value, [(f.is_null(n), "null_title"), (f.not_string(n), "bad_type:title")]


BOARD_A_FIELDS = {
    "title": "$.title",
    "location": "$.location",
    "name": "$.location.name",
    "content": "$.content",
    "updated_at": "$.updated_at",
    "absolute_url": "$.absolute_url",
}


def map_board_a(f: Fields, url: Column) -> Mapped:
    """``{id, title, updated_at, location{name}, absolute_url, content}``."""
    title, title_checks = _title(f, "title")
    loc_ok = f.truthy("location")
    location = F.when(loc_ok, f.s("name"))
    description = strip_html(F.when(f.truthy("content"), f.s("content")))
    reject = _first_reason(
        *title_checks,
        (loc_ok & ~f.is_object("location"), "bad_structure:location"),
        (loc_ok & f.not_string("name"), "bad_type:location.name"),
        (f.truthy("content") & f.not_string("content"), "bad_type:content"),
        (f.truthy("updated_at") & f.not_string("updated_at"), "bad_type:updated_at"),
        (F.nullif(url, F.lit("")).isNull() & f.not_string("absolute_url"), "bad_type:absolute_url"),
    )
    return Mapped(
        title=title,
        location=location,
        description=description,
        publication_text=F.when(f.truthy("updated_at"), f.s("updated_at")),
        link=falsy_fallback(url, f.s("absolute_url")),
        remote_flag=F.lit(False),
        reject=reject,
    )


BOARD_B_FIELDS = {
    "name": "$.name",
    "location": "$.location",
    "city": "$.location.city",
    "region": "$.location.region",
    "country": "$.location.country",
    "remote": "$.location.remote",
    "jobAd": "$.jobAd",
    "sections": "$.jobAd.sections",
    "jobDescription": "$.jobAd.sections.jobDescription",
    "text": "$.jobAd.sections.jobDescription.text",
    "releasedDate": "$.releasedDate",
    "applyUrl": "$.applyUrl",
}


def map_board_b(f: Fields, url: Column) -> Mapped:
    """``{id, name, location{city, region, country, remote}, releasedDate,
    applyUrl, jobAd{sections{jobDescription{text}}}}``; description HTML is kept."""
    title, title_checks = _title(f, "name")
    loc_ok = f.truthy("location")
    parts = ("city", "region", "country")
    location = F.when(loc_ok, format_location(*(F.when(f.truthy(p), f.s(p)) for p in parts)))
    remote_flag = loc_ok & f.truthy("remote")
    ad_ok = f.truthy("jobAd")
    description = F.when(ad_ok, f.s("text"))
    reject = _first_reason(
        *title_checks,
        (loc_ok & ~f.is_object("location"), "bad_structure:location"),
        *[(loc_ok & f.truthy(p) & f.not_string(p), f"bad_type:location.{p}") for p in parts],
        (ad_ok & ~f.is_object("jobAd"), "bad_structure:jobAd"),
        (ad_ok & f.present("sections") & ~f.is_object("sections"), "bad_structure:sections"),
        (ad_ok & f.present("jobDescription") & ~f.is_object("jobDescription"), "bad_structure:jobDescription"),
        (ad_ok & f.not_string("text"), "bad_type:text"),
        (f.truthy("releasedDate") & f.not_string("releasedDate"), "bad_type:releasedDate"),
        (F.nullif(url, F.lit("")).isNull() & f.not_string("applyUrl"), "bad_type:applyUrl"),
    )
    # upstream replaces every "Z" by "+00:00" before parsing
    released = F.replace(f.s("releasedDate"), F.lit("Z"), F.lit("+00:00"))
    return Mapped(
        title=title,
        location=location,
        description=description,
        publication_text=F.when(f.truthy("releasedDate"), released),
        link=falsy_fallback(url, f.s("applyUrl")),
        remote_flag=remote_flag,
        reject=reject,
    )


# Source name -> mapping.  Adding a source means adding one entry.
MAPPINGS: dict[str, SourceMapping] = {
    "greenhouse": SourceMapping(BOARD_A_FIELDS, map_board_a),
    "smartrecruiters": SourceMapping(BOARD_B_FIELDS, map_board_b),
}

CARRY = ["ingestion_date", "fetched_at", "raw_payload"]


def normalize(bronze: DataFrame, mappings: Mapping[str, SourceMapping] | None = None) -> DataFrame:
    """Map every Bronze row to Silver columns in one pass.

    Output: the Silver columns (``technologies`` NULL, filled later by P1),
    plus ``ingestion_date, fetched_at, raw_payload`` for the latest-row order,
    plus ``reject_reason`` (NULL for good rows).
    """
    maps = dict(MAPPINGS if mappings is None else mappings)
    if not maps:
        raise ValueError("at least one source mapping is required")
    df = bronze
    for stage in _stages(tuple(maps.items())):
        df = df.select(*stage)
    return df


@per_context
def _stages(maps_items: tuple) -> list[list[Column]]:
    """The four projections of :func:`normalize` (built once per session)."""
    maps = dict(maps_items)
    base = ["source", "source_job_id", "company_identifier", "url", *CARRY]
    prefixes = {name: f"_f{i}_" for i, name in enumerate(maps)}
    fields = [(f"{prefixes[name]}{fname}", path) for name, m in maps.items() for fname, path in m.fields.items()]

    # (1) parse once: the top-level keys of the registered paths as VARIANT
    keys = {path.split(".")[1] for _, path in fields}
    raw = F.col("raw_payload")
    extract = [
        *base,
        read_object(raw, {k: "variant" for k in sorted(keys)}).alias("_p"),
        (~is_object_text(raw) & F.try_parse_json(raw).isNotNull()).alias("_other"),
    ]

    def at(path: str) -> Column:
        key, *inner = path.split(".")[1:]
        top = F.col(f"_p.{key}")
        return F.try_variant_get(top, ".".join(["$", *inner]), "variant") if inner else top

    pull = [*base, F.col("_p").isNotNull().alias("_object"), "_other", *[at(path).alias(f"{n}__v") for n, path in fields]]
    # (2) type and string value of every field, once; then truthiness
    typed = [*base, "_object", "_other"]
    for n, _ in fields:
        c = F.col(f"{n}__v")
        typed += [c.alias(f"{n}__v"), vtype(c).alias(f"{n}__t"), F.try_variant_get(c, "$", "string").alias(f"{n}__s")]
    truth = ["*", *[truthy(F.col(f"{n}__v"), F.col(f"{n}__t")).alias(f"{n}__b") for n, _ in fields]]
    # (3) the mappings, switched by source
    url = F.col("url")
    per_source = {name: m.build(Fields(prefixes[name]), url) for name, m in maps.items()}

    def switch(attr: str) -> Column:
        out = None
        for name, mp in per_source.items():
            expr = getattr(mp, attr)
            out = F.when(F.col("source") == name, expr) if out is None else out.when(F.col("source") == name, expr)
        return out

    reason = (
        F.when(~F.col("source").isin(*maps), F.concat(F.lit("unknown_source:"), F.col("source")))
        .when(F.col("_other"), F.lit("payload_not_object"))
        .when(~F.col("_object"), F.lit("malformed_json"))
        .otherwise(switch("reject"))
    )
    switched = [
        F.concat_ws(":", F.col("source"), F.col("source_job_id")).alias("job_id"),
        F.col("company_identifier").alias("company"),
        "source",
        *[switch(a).alias(a) for a in ("title", "location", "description", "publication_text", "link", "remote_flag")],
        *CARRY,
        reason.alias("reject_reason"),
    ]
    # (4) steps shared by all sources, evaluated once
    final = [
        "job_id",
        "company",
        "title",
        "location",
        (F.coalesce(F.col("remote_flag"), F.lit(False)) | looks_remote("location", "title", "description")).alias("remote"),
        F.lit(None).cast("string").alias("salary"),
        "description",
        F.lit(None).cast("array<string>").alias("technologies"),
        "source",
        parse_iso_timestamp(F.col("publication_text")).alias("publication_date"),
        "link",
        *CARRY,
        "reject_reason",
    ]
    return [extract, pull, typed, truth, switched, final]


def split_rejects(mapped: DataFrame, on_error: str = "quarantine") -> tuple[DataFrame, DataFrame]:
    """(good rows, rejected rows).

    ``on_error='fail'`` keeps the upstream contract instead: the first bad row
    fails the job with its reason (``raise_error`` inside a column that is
    always computed).
    """
    bad = F.col("reject_reason").isNotNull()
    if on_error == "fail":
        checked = mapped.withColumn(
            "job_id",
            F.when(bad, F.raise_error(F.concat(F.lit("cannot map "), F.col("job_id"), F.lit(": "), F.col("reject_reason")))).otherwise(
                F.col("job_id")
            ),
        )
        return checked.drop("reject_reason"), mapped.limit(0)
    if on_error != "quarantine":
        raise ValueError("on_error must be 'quarantine' or 'fail'")
    return mapped.filter(~bad).drop("reject_reason"), mapped.filter(bad)


def silver_projection(df: DataFrame, more: Sequence[Column] = ()) -> DataFrame:
    """Silver columns in schema order, then ``more``."""
    return df.select(*SILVER_COLUMNS, *more)
