"""Text functions (F1-F8) and JSON truthiness."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from talentflow.functions.json import truthy
from talentflow.functions.text import (
    falsy_fallback,
    format_location,
    looks_remote,
    parse_iso_timestamp,
    strip_html,
    title_key,
)

from .conftest import one_col


def col(spark, values, expr, ddl="t string"):
    return [r[0] for r in one_col(spark, values, ddl).select(expr).collect()]


def test_strip_html(spark):
    got = col(
        spark,
        [
            "<p>Great <b>remote</b> opportunity</p>",
            None,
            "",
            "<br/> <i></i>",
            "a  b\u0085c d\u001ce",
            "<p>Tom &amp; Jerry</p>",
            "<script>var x = 1;</script>ok",
            "line1\n\n\tline2",
            "a\u00a0\u00a0b\u2003c\u3000",
        ],
        strip_html("t"),
    )
    assert got == ["Great remote opportunity", None, None, None, "a b c d e", "Tom &amp; Jerry", "var x = 1; ok", "line1 line2", "a b c"]


def test_format_location(spark):
    df = spark.createDataFrame(
        [("Milan", "Lombardy", "it"), ("Milan", None, "it"), ("", "", None), (None, None, None), ("Rome", "", "")],
        "c string, r string, k string",
    )
    got = [x[0] for x in df.select(format_location("c", "r", "k")).collect()]
    assert got == ["Milan, Lombardy, it", "Milan, it", None, None, "Rome"]


def test_looks_remote(spark):
    df = spark.createDataFrame(
        [("Remote - EU", None, None), (None, "Engineer", "works remotely"), ("Milan", "smart", "working"), (None, None, None), ("", "x", "Telelavoro")],
        "a string, b string, c string",
    )
    got = [x[0] for x in df.select(looks_remote("a", "b", "c")).collect()]
    assert got == [True, True, True, False, True]


def test_falsy_fallback_and_title_key(spark):
    df = spark.createDataFrame([("", "x"), (None, "y"), ("u", "z")], "u string, p string")
    assert [x[0] for x in df.select(falsy_fallback("u", "p")).collect()] == ["x", "y", "u"]
    assert col(spark, ["  Data \t  Engineer ", "data engineer"], title_key("t")) == ["data engineer", "data engineer"]


def test_parse_iso_timestamp(spark):
    vals = [
        "2026-01-14T10:55:28-05:00",
        "2026-01-14T10:55:28.000Z",
        "2026",
        "20260114T105528",
        "2026-02-30T00:00:00Z",
        "",
        None,
        "garbage",
        "2026-01-14 10:55+01",
    ]
    got = col(spark, vals, F.unix_seconds(parse_iso_timestamp("t")))
    exp = []
    for v in vals:
        try:
            d = dt.datetime.fromisoformat(v)
            d = d if d.tzinfo else d.replace(tzinfo=dt.timezone.utc)
            exp.append(int(d.timestamp()))
        except (TypeError, ValueError):
            exp.append(None)
    assert got == exp


def test_truthy(spark):
    vals = ['{"r": true}', '{"r": false}', '{"r": "false"}', '{"r": ""}', '{"r": 0}', '{"r": 0.0}', '{"r": 2}',
            '{"r": []}', '{"r": [0]}', '{"r": {}}', '{"r": {"a": 1}}', '{"r": null}', "{}"]
    got = col(spark, vals, truthy(F.try_variant_get(F.try_parse_json("t"), "$.r", "variant")))
    assert got == [True, False, True, False, False, False, True, False, True, False, True, False, False]
