"""Secret scans with DataFrame functions only.

Base kinds are found by pattern; on top of them a sliding-window Shannon
entropy marks the random-looking part of candidate strings.

Positions come from one regular-expression pass per kind: the pattern
``(.*?)(kind|\\z)`` cuts a text into consecutive (gap, match) parts, so the
start of a match is a running sum of lengths - linear in the text, and nothing
but the short matches leaves the scan.  The running sum is a window per
document over the matches of that one document.

The entropy of a window of W characters is log2(W) - sum(c*log2(c))/W over its
character counts c.  The fold over a candidate carries the counts themselves: a
step takes one character out and one in, and the sum changes by two looked-up
differences (scaled to integers, hence exact).  The numbers of digits, small and
capital letters and characters that are no hexadecimal digit slide along, so
every window is judged by its own character class, whatever stands next to it.
A candidate ends at ``=`` (base64 padding stays with it) and at allow-listed text
(UUIDs, placeholders, sequences): no window overlaps that.
"""

from __future__ import annotations

import math
import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import ROW, keyed_texts, shared, text_of

# The base patterns.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
MIN_VALUE, MIN_ACCESS, MIN_HEX = 12, 18, 16
KINDS = ("assign", "access", "hex", "entropy")

WINDOW = 20
RUN = r"[A-Za-z0-9+/_-]"
ALPHABET = string.ascii_uppercase + string.ascii_lowercase + string.digits + "+/_-="
# Bits a window must reach, by its character class (the largest possible value
# for 20 characters is 4.32): hexadecimal, one letter case with digits, both
# cases with digits.  A window without a digit or without a letter has no class.
THRESHOLDS = {"hex": 3.0, "mono": 3.55, "mixed": 3.8}
ALLOW = (
    r"[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}",
    r"(?i:example|sample|placeholder|changeme|xxxxxx|0123456789|abcdefgh)",
)
LISTED = "|".join(ALLOW)
CANDIDATE = rf"(?={RUN}{{{WINDOW}}})(?:(?!{LISTED}){RUN}){{{WINDOW},}}+={{0,2}}"
SCALE = 1 << 24


def weight(count: int) -> int:
    """c*log2(c) in units of 1/SCALE."""
    return round(count * math.log2(count) * SCALE) if count else 0


def _parts(text: Column, pattern: str, min_run: str = "") -> Column:
    """array<struct<gap, value>>: consecutive parts of the text; the value is
    empty in the last one.  The second pass runs only on texts with a match."""
    whole = rf"(?s)(.*?)({pattern}|\z)"
    gaps = F.regexp_extract_all(text, F.lit(whole), F.lit(1))
    values = F.regexp_extract_all(text, F.lit(whole), F.lit(2))
    pairs = F.arrays_zip(gaps.alias("gap"), values.alias("value"))
    lengths = F.transform(pairs, lambda p: F.struct(F.char_length(p["gap"]).alias("gap"), p["value"].alias("value")))
    return F.when(F.regexp_like(text, F.lit(min_run or pattern)), lengths)


def class_limits() -> dict[str, int]:
    """The largest scaled sum of a window that reaches the threshold of its class."""
    return {k: round((math.log2(WINDOW) - v) * WINDOW * SCALE) for k, v in THRESHOLDS.items()}


# Numbers of characters of a window, 8 bits each in one long.
DIGIT, LOWER, UPPER, NOT_HEX = (1 << 8 * k for k in range(4))


def _unit(c: str) -> int:
    kind = DIGIT if c in string.digits else LOWER if c in string.ascii_lowercase else UPPER if c in string.ascii_uppercase else 0
    return kind + (0 if c in string.hexdigits else NOT_HEX)


def _limit(classes: Column) -> Column:
    limits = class_limits()
    any_of = lambda unit: classes.bitwiseAND(F.lit(255 * unit)) != 0
    return (
        F.when(~any_of(DIGIT) | ~any_of(LOWER + UPPER), F.lit(-1))
        .when(~any_of(NOT_HEX), F.lit(limits["hex"]))
        .when(any_of(LOWER) & any_of(UPPER), F.lit(limits["mixed"]))
        .otherwise(F.lit(limits["mono"]))
    )


def _hot_windows(s: Column) -> Column:
    """struct<first, last>: 0-based starts of the first and last window of
    ``s`` that reaches the threshold of its class, -1 if none."""
    longs = lambda values: F.array(*[F.lit(v) for v in values]).cast("array<long>")
    gain = longs(weight(n + 1) - weight(n) for n in range(WINDOW + 1))
    loss = longs(weight(n - 1) - weight(n) if n else 0 for n in range(WINDOW + 1))
    units = longs([0, *map(_unit, ALPHABET)])
    zero = ord("@")  # a count is one character, "@" for none, at the place of its letter

    def scan(codes: Column) -> Column:
        def slide(acc: Column, i: Column) -> Column:
            # acc holds the window that ends before i: judge it, then take i in
            counts, new, out = acc["counts"], F.get(codes, i), F.get(codes, i - WINDOW)
            n = lambda c: F.ascii(F.substr(counts, c, F.lit(1))) - zero
            put = lambda into, c, number: F.overlay(into, F.char(number + zero), c, F.lit(1))
            without = F.when(out.isNull(), counts).otherwise(put(counts, out, n(out) - 1))
            same = out.eqNullSafe(new)
            change = F.get(gain, n(new)) + F.coalesce(F.get(loss, n(out)), F.lit(0))
            hot = (i >= WINDOW) & (acc["total"] <= _limit(acc["classes"]))
            return F.struct(
                F.when(same, counts).otherwise(put(without, new, n(new) + 1)).alias("counts"),
                (acc["classes"] + F.get(units, new) - F.coalesce(F.get(units, out), F.lit(0))).alias("classes"),
                (acc["total"] + F.when(same, F.lit(0)).otherwise(change)).cast("long").alias("total"),
                F.when(hot & (acc["first"] < 0), i - WINDOW).otherwise(acc["first"]).alias("first"),
                F.when(hot, i - WINDOW).otherwise(acc["last"]).alias("last"),
            )

        empty = F.struct(
            F.lit(chr(zero) * len(ALPHABET)).alias("counts"),
            F.lit(0).cast("long").alias("classes"),
            F.lit(0).cast("long").alias("total"),
            F.lit(-1).alias("first"),
            F.lit(-1).alias("last"),
        )
        return F.aggregate(F.sequence(F.lit(0), F.size(codes)), empty, slide, lambda acc: F.struct(acc["first"].alias("first"), acc["last"].alias("last")))

    # transform over a one-element array binds the codes once: inside the loop
    # they are a variable, not the split computed again at every step.
    codes = F.transform(F.split(s, ""), lambda c: F.instr(F.lit(ALPHABET), c))
    return F.get(F.transform(F.array(codes), scan), F.lit(0))


def secret_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per found span: (doc_id, kind, start, end, value); positions in
    code points, end exclusive.  Base kinds: the whole match; ``entropy``: from the
    first to the last window of a candidate that reaches the threshold of its class.

    Null and empty texts have no span; rows that repeat an id are scanned
    each, and their spans are numbered apart.  Other columns are ignored.
    """
    return _spans(text_of(docs, id_col, text_col).withColumn("row", F.monotonically_increasing_id()))


def _spans(src: DataFrame) -> DataFrame:
    """The spans of ``src`` (doc_id, row, text), numbered by ``row``."""
    text = F.col("text")
    parts = src.select(
        "doc_id",
        "row",
        F.array(
            F.struct(F.lit("assign").alias("kind"), _parts(text, ASSIGN.replace("([", "(?:[")).alias("parts")),
            F.struct(F.lit("access").alias("kind"), _parts(text, ACCESS).alias("parts")),
            F.struct(F.lit("hex").alias("kind"), _parts(text, HEX.replace("+", "{16,}")).alias("parts")),
            F.struct(F.lit("entropy").alias("kind"), _parts(text, f"{LISTED}|{CANDIDATE}", f"{RUN}{{{WINDOW}}}").alias("parts")),
        ).alias("kinds"),
    )
    rows = (
        parts.select("doc_id", "row", F.explode("kinds").alias("k"))
        .filter("k.parts is not null")
        .select("doc_id", "row", "k.kind", F.posexplode("k.parts").alias("n", "part"))
        .filter("part.value <> ''")
        .select("doc_id", "row", "kind", "n", "part.gap", F.col("part.value").alias("value"))
    )
    rows = shared(rows)  # read by the base and the entropy branch: one scan of the texts
    order = Window.partitionBy("doc_id", "row", "kind").orderBy("n")
    located = rows.withColumn("end", F.sum(F.col("gap") + F.char_length("value")).over(order)).withColumn(
        "start", F.col("end") - F.char_length("value")
    )
    value = F.col("value")
    group2 = F.regexp_extract(value, ASSIGN, 1)
    base = located.filter(
        ((F.col("kind") == "assign") & (F.char_length(group2) >= MIN_VALUE))
        | ((F.col("kind") == "access") & (F.char_length(value) >= MIN_ACCESS))
        | ((F.col("kind") == "hex") & (F.char_length(value) >= MIN_HEX))
    ).select("doc_id", "row", "kind", "start", "end", "value")
    entropy = (
        located.filter((F.col("kind") == "entropy") & ~value.rlike(rf"\A(?:{LISTED})\z") & value.rlike("[0-9]") & value.rlike("[A-Za-z]"))
        .select("doc_id", "row", "kind", "start", "value", _hot_windows(value).alias("hot"))
        .filter("hot.first >= 0")
        .select(
            "doc_id",
            "row",
            "kind",
            (F.col("start") + F.col("hot.first")).alias("start"),
            (F.col("start") + F.col("hot.last") + WINDOW).alias("end"),
            F.expr(f"substring(value, hot.first + 1, hot.last - hot.first + {WINDOW})").alias("value"),
        )
    )
    return base.unionByName(entropy)


def secret_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_assign, n_access, n_hex, n_entropy,
    base_sha256, spans.  Rows with a null or repeated id are documents of their
    own; an empty table gives an empty result."""
    src = keyed_texts(docs, id_col, text_col).withColumnRenamed(ROW, "row")
    rank = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind")).cast("int")
    item = F.struct("start", rank.alias("rank"), "end", F.concat_ws(":", "kind", "start", "end").alias("span"))
    names = lambda c: F.array_join(F.transform(F.array_sort(c), lambda s: s["span"]), ",")
    found = (
        _spans(src)
        .groupBy("row")
        .agg(
            *[F.count_if(F.col("kind") == k).alias(f"n_{k}") for k in KINDS],
            names(F.collect_list(F.when(F.col("kind") != "entropy", item))).alias("base"),
            names(F.collect_list(item)).alias("spans"),
        )
    )
    return src.select("row", "doc_id").join(found, "row", "left").select(
        "doc_id",
        *[F.coalesce(f"n_{k}", F.lit(0).cast("long")).alias(f"n_{k}") for k in KINDS],
        F.sha2(F.coalesce("base", F.lit("")), 256).alias("base_sha256"),
        F.coalesce("spans", F.lit("")).alias("spans"),
    )


def oracle() -> str:
    """The same report in DuckDB SQL: listed text is blanked, window sums are from scratch."""
    quote = lambda s: s.replace("'", "''")
    part = (
        "SELECT doc_id, '{k}' AS kind, {r} AS rank, n, length(g) + length(v) AS step, v FROM ("
        "SELECT doc_id, unnest(regexp_extract_all({t}, '(?s)(.*?)({p}|\\z)', 1)) AS g,"
        " unnest(regexp_extract_all({t}, '(?s)(.*?)({p}|\\z)', 2)) AS v,"
        " unnest(range(len(regexp_extract_all({t}, '(?s)(.*?)({p}|\\z)', 1)))) AS n FROM d)"
    )
    kinds = [("assign", ASSIGN.replace("([", "(?:[")), ("access", ACCESS), ("hex", HEX), ("entropy", f"{RUN}{{{WINDOW},}}={{0,2}}")]
    parts = " UNION ALL ".join(part.format(k=k, r=i, p=quote(p), t="blanked" if k == "entropy" else "text") for i, (k, p) in enumerate(kinds))
    limits = class_limits()
    weights = ", ".join(str(weight(c)) for c in range(WINDOW + 1))
    return rf"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
d AS (
  SELECT doc_id, text, CASE WHEN regexp_matches(text, '{LISTED}') THEN array_to_string(list_transform(
    list_zip(regexp_extract_all(text, '(?s)(.*?)({LISTED}|\z)', 1), regexp_extract_all(text, '(?s)(.*?)({LISTED}|\z)', 2)),
    lambda x: x[1] || repeat(' ', length(x[2]))), '') ELSE text END AS blanked
  FROM t
),
p AS ({parts}),
l AS (SELECT *, sum(step) OVER (PARTITION BY doc_id, kind ORDER BY n) AS e FROM p),
base AS (
  SELECT doc_id, kind, rank, e - length(v) AS s, e FROM l WHERE v <> '' AND (
    (kind = 'assign' AND length(regexp_extract(v, '{quote(ASSIGN)}', 1)) >= {MIN_VALUE})
    OR (kind = 'access' AND length(v) >= {MIN_ACCESS}) OR (kind = 'hex' AND length(v) >= {MIN_HEX}))
),
cand AS (
  SELECT doc_id, e - length(v) AS s, v FROM l
  WHERE kind = 'entropy' AND v <> '' AND regexp_matches(v, '[0-9]') AND regexp_matches(v, '[A-Za-z]')
),
win AS (
  SELECT doc_id, s, i, w, CASE
    WHEN regexp_full_match(w, '[0-9a-fA-F]+') THEN {limits["hex"]}
    WHEN regexp_matches(w, '[A-Z]') AND regexp_matches(w, '[a-z]') THEN {limits["mixed"]}
    ELSE {limits["mono"]} END AS lim
  FROM (SELECT doc_id, s, i, substr(v, i + 1, {WINDOW}) AS w FROM (SELECT *, unnest(range(length(v) - {WINDOW - 1})) AS i FROM cand))
  WHERE regexp_matches(w, '[0-9]') AND regexp_matches(w, '[A-Za-z]')
),
cnt AS (
  SELECT doc_id, s, lim, i, c, count(*) AS n
  FROM (SELECT doc_id, s, lim, i, unnest(string_split(w, '')) AS c FROM win) GROUP BY ALL
),
hot AS (
  SELECT doc_id, s, i FROM (SELECT doc_id, s, lim, i, sum(([{weights}])[n + 1]) AS total FROM cnt GROUP BY doc_id, s, lim, i)
  WHERE total <= lim
),
spans AS (
  SELECT doc_id, kind, rank, s, e FROM base UNION ALL
  SELECT doc_id, 'entropy', 3, s + min(i), s + max(i) + {WINDOW} FROM hot GROUP BY doc_id, s
),
r AS (
  SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
    count(*) FILTER (kind = 'hex') AS n_hex, count(*) FILTER (kind = 'entropy') AS n_entropy,
    coalesce(string_agg(kind || ':' || s::BIGINT || ':' || e::BIGINT, ',' ORDER BY s, rank, e) FILTER (kind <> 'entropy'), '') AS base,
    string_agg(kind || ':' || s::BIGINT || ':' || e::BIGINT, ',' ORDER BY s, rank, e) AS spans
  FROM spans GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  coalesce(n_entropy, 0) AS n_entropy, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN r USING (doc_id)
"""
