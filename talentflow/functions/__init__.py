"""Column functions. Every function returns a ``pyspark.sql.Column`` built only
from Spark built-ins, so plans stay inside whole-stage codegen."""

from .text import (
    format_location,
    looks_remote,
    parse_iso_timestamp,
    strip_html,
    title_key,
    falsy_fallback,
)
from .terms import extract_terms, extract_technologies, extract_keywords, required_years, term_pattern
from .json import truthy

__all__ = [
    "format_location",
    "looks_remote",
    "parse_iso_timestamp",
    "strip_html",
    "title_key",
    "falsy_fallback",
    "extract_terms",
    "extract_technologies",
    "extract_keywords",
    "required_years",
    "term_pattern",
    "truthy",
]
