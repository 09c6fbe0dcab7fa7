"""Helpers over VARIANT values parsed from JSON payload text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def field(v: Column, path: str) -> Column:
    """The value at ``path`` as VARIANT: SQL NULL when the key is absent,
    a VOID variant when it is present with JSON null."""
    return F.try_variant_get(v, path, "variant")


def vtype(x: Column) -> Column:
    """Type name of a VARIANT (``STRING``, ``BIGINT``, ``OBJECT<...>``, ``VOID``...)."""
    return F.schema_of_variant(x)


# Strings of any length, and no spelling that json.loads refuses.
_READ = {"maxStringLen": str(2**31 - 1), "allowSingleQuotes": "false", "mode": "PERMISSIVE"}


def read_object(text: Column, fields: dict[str, str]) -> Column:
    """The given top-level fields (name -> type) of a JSON object as a struct,
    NULL unless the whole text is one object.

    Read as ``json.loads`` reads it: of a repeated key the last value counts,
    text after the object makes it invalid, and no size limit applies to the
    object.  A field of type VARIANT is SQL NULL when the key is absent and a
    VOID variant when it holds null (a value that repeats a key *inside* itself
    counts as absent).  The text is parsed as the one element of an array, so
    that trailing text cannot go unnoticed.
    """
    schema = "array<struct<" + ", ".join(f"`{k}`: {t}" for k, t in fields.items()) + ">>"
    rows = F.from_json(F.concat(F.lit("["), text, F.lit("]")), schema, _READ)
    return F.when(is_object_text(text) & (F.size(rows) == 1), F.get(rows, F.lit(0)))


def is_object_text(text: Column) -> Column:
    return F.ltrim(text, F.lit(" \t\n\r")).startswith("{")


def python_str(x: Column) -> Column:
    """A scalar VARIANT as Python's ``str`` spells it; NULL when absent.
    (Objects and arrays keep their JSON text.)"""
    t = vtype(x)
    text = F.try_variant_get(x, "$", "string")
    return (
        F.when(x.isNull(), F.lit(None).cast("string"))
        .when(t == "VOID", F.lit("None"))
        .when(t == "BOOLEAN", F.initcap(text))
        .when(t.startswith("DECIMAL"), F.try_variant_get(x, "$", "double").cast("string"))
        .otherwise(text)
    )


def truthy(x: Column, t: Column | None = None) -> Column:
    """Python truthiness of a JSON value; absent and null are false.

    boolean -> its value; number -> non-zero; string -> non-empty;
    object / array -> non-empty.  ``t`` may pass a precomputed type name.
    """
    t = vtype(x) if t is None else t
    return (
        F.when(x.isNull() | (t == "VOID"), F.lit(False))
        .when(t == "BOOLEAN", F.try_variant_get(x, "$", "boolean"))
        .when(t == "STRING", F.try_variant_get(x, "$", "string") != F.lit(""))
        .when(t.startswith("OBJECT"), t != F.lit("OBJECT<>"))
        .when(t.startswith("ARRAY"), F.size(F.try_variant_get(x, "$", "array<variant>")) > 0)
        .otherwise(F.coalesce(F.try_variant_get(x, "$", "double") != F.lit(0.0), F.lit(True)))
    )
