"""Text normalisation functions (F1-F8)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..catalogs import REMOTE_MARKERS
from .patterns import PY_WHITESPACE_CLASS

ColumnOrName = Column | str


def _c(x: ColumnOrName) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _blank_to_null(x: ColumnOrName) -> Column:
    """NULL for NULL and for the empty string (Python falsiness of a str)."""
    return F.nullif(_c(x), F.lit(""))


def strip_html(text: ColumnOrName) -> Column:
    """replace each tag by a space, collapse whitespace, trim.

    NULL / empty input and input that is only tags and whitespace give NULL.
    Entities are not decoded; script/style bodies are kept (tags only).
    """
    no_tags = F.regexp_replace(_c(text), F.lit("<[^>]+>"), F.lit(" "))
    collapsed = F.regexp_replace(no_tags, F.lit(PY_WHITESPACE_CLASS + "+"), F.lit(" "))
    return F.nullif(F.trim(collapsed), F.lit(""))


def format_location(city: ColumnOrName, region: ColumnOrName, country: ColumnOrName) -> Column:
    """non-empty parts joined by ", "; NULL when nothing is left."""
    joined = F.concat_ws(", ", _blank_to_null(city), _blank_to_null(region), _blank_to_null(country))
    return F.nullif(joined, F.lit(""))


def looks_remote(*texts: ColumnOrName, markers: Iterable[str] = REMOTE_MARKERS) -> Column:
    """lower-cased non-empty texts joined by a space contain a marker.

    Substring semantics (``remotely`` counts); never NULL.
    """
    combined = F.lower(F.concat_ws(" ", *[_blank_to_null(t) for t in texts]))
    cond = F.lit(False)
    for m in markers:
        cond = cond | combined.contains(m.lower())
    return cond


def falsy_fallback(primary: ColumnOrName, fallback: ColumnOrName) -> Column:
    """``primary or fallback`` for strings: NULL and '' fall through."""
    return F.coalesce(_blank_to_null(primary), _c(fallback))


def title_key(title: ColumnOrName) -> Column:
    """F8: collapse whitespace runs (Java ``\\s``), trim, lower-case."""
    return F.lower(F.trim(F.regexp_replace(_c(title), F.lit(r"\s+"), F.lit(" "))))


# ISO-8601 shapes accepted (as by Python 3.13's datetime.fromisoformat):
#   date      YYYY-MM-DD | YYYYMMDD
#   then optionally: one separator character of any kind, and a time
#   time      HH[:MM[:SS[.f+]]] | HHMM[SS[.f+]]   ('.' or ',' before the fraction)
#   offset    Z | +HH[:MM[:SS]] | +HHMM[SS]       (or '-'), below 24 hours
# The date and time parts may use the basic and extended forms independently.
# Not supported (NULL here): week dates (2024-W10-2) and fractions in offsets.
_ISO_GUARD = (
    r"^(?:\d{4}-\d{2}-\d{2}|\d{8})"
    r"(?:[\s\S](?:\d{2}(?::\d{2}(?::\d{2}(?:[.,]\d+)?)?)?|\d{4}(?:\d{2}(?:[.,]\d+)?)?)"
    r"(?:Z|[+-]\d{2}(?::?\d{2}(?::?\d{2})?)?)?)?$"
)


def parse_iso_timestamp(value: ColumnOrName) -> Column:
    """ISO-8601 text -> TIMESTAMP; NULL for NULL, '' or an invalid value.

    A shape guard runs first (Spark's own cast accepts values such as '2026'
    that an ISO parser rejects); the pieces are then re-assembled into the
    canonical ``yyyy-MM-ddTHH:mm:ss.ffffff[+HH:MM]`` form and parsed with
    ``try_to_timestamp``, which gives NULL for impossible dates.  Values with
    an offset denote one instant; naive values use the session time zone.
    """
    v = _c(value)
    extended = F.substring(v, 5, 1) == "-"
    month = F.when(extended, F.substring(v, 6, 2)).otherwise(F.substring(v, 5, 2))
    day = F.when(extended, F.substring(v, 9, 2)).otherwise(F.substring(v, 7, 2))
    # after the separator, to the end however long
    rest = v.substr(F.when(extended, F.lit(12)).otherwise(F.lit(10)), F.char_length(v))
    parts = r"^([0-9:]+)([.,][0-9]+)?(.*)$"
    digits = F.replace(F.regexp_extract(rest, parts, 1), F.lit(":"), F.lit(""))
    frac = F.rpad(F.substring(F.regexp_extract(rest, parts, 2), 2, 6), 6, "0")
    off_raw = F.replace(F.regexp_extract(rest, parts, 3), F.lit(":"), F.lit(""))
    hh = F.coalesce(F.nullif(F.substring(digits, 1, 2), F.lit("")), F.lit("00"))
    mi = F.coalesce(F.nullif(F.substring(digits, 3, 2), F.lit("")), F.lit("00"))
    ss = F.coalesce(F.nullif(F.substring(digits, 5, 2), F.lit("")), F.lit("00"))
    # the offset is applied by arithmetic: a zone text may not exceed 18 hours
    part = lambda at: F.coalesce(F.nullif(F.substring(off_raw, at, 2), F.lit("")), F.lit("0")).try_cast("int")
    shifted = off_raw.rlike("^[+-]")
    sign = F.when(off_raw.startswith("-"), F.lit(-1)).otherwise(F.lit(1))
    offset = sign * (part(2) * 3600 + part(4) * 60 + part(6)).cast("bigint")
    off = F.when(off_raw == "", F.lit("")).otherwise(F.lit("Z"))
    in_range = (hh.cast("int") <= 23) & (mi.cast("int") <= 59) & (ss.cast("int") <= 59)
    in_range = in_range & (~shifted | ((part(2) <= 23) & (part(4) <= 59) & (part(6) <= 59)))
    canonical = F.concat(
        F.substring(v, 1, 4), F.lit("-"), month, F.lit("-"), day, F.lit("T"),
        hh, F.lit(":"), mi, F.lit(":"), ss, F.lit("."), frac, off,
    )
    stamp = F.try_to_timestamp(canonical)
    moved = F.when(shifted, F.timestamp_micros(F.unix_micros(stamp) - offset * 1_000_000)).otherwise(stamp)
    return F.when(v.rlike(_ISO_GUARD) & in_range, moved)
