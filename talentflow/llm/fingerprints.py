"""Document fingerprints: a homomorphic multiset hash of paragraphs
(DataFrame operations only).

A paragraph is a line, cut after the ends of its sentences, without surrounding
blanks.  Its SHA-256 gives a wide vector: eight words, added modulo 2**32, and
128 signs +1 / -1, added modulo 2**16.  The sum over a document's paragraphs does
not depend on their order; equal multisets have equal sums, and paragraphs are
inserted and deleted by adding and subtracting their vectors.

The squared length of a difference of sign sums estimates how many paragraphs
two documents do not share, so two fingerprints alone tell their likeness.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ROW, keyed_texts, shared

BLANKS = " \t\n\x0b\x0c\r"
WORDS, SIGN_WORDS, WORD_BITS = 8, 4, 32
WORD_MASK, LANE_BITS = (1 << WORD_BITS) - 1, 16
LANE_MASK, HALF_LANE = (1 << LANE_BITS) - 1, 1 << (LANE_BITS - 1)
PAIR_MASK = 1 << WORD_BITS | 1  # the lowest bit of each of two words
PLACE_BITS = 33  # of a row within its partition, in monotonically increasing ids


def paragraphs(text: Column) -> Column:
    """The paragraphs of a text, as an array without blank ones."""
    lines = F.split(F.regexp_replace(text, r"([.!?])[ \t\n\x0B\f\r]+", "$1\n"), "\n")
    return F.filter(F.transform(lines, lambda p: F.trim(p, F.lit(BLANKS))), lambda p: p != "")


def _word(digest: Column, k: int) -> Column:
    return F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long")


def _shift(value: Column, by: Column | int) -> Column:
    return F.call_function("shiftrightunsigned", value, F.lit(by) if isinstance(by, int) else by)


def _total(values: Column, part) -> Column:
    return F.aggregate(values, F.lit(0).cast("long"), lambda total, value: total + part(value))


def _word_pairs(digests: Column, k: int) -> Column:
    """Words k (low) and k + 1 of every digest as one number."""
    return F.transform(digests, lambda h: F.shiftleft(_word(h, k + 1), WORD_BITS).bitwiseOR(_word(h, k)))


def _bit_counts(pairs: Column) -> Column:
    """Per bit, how many words have it; low and high words in one number."""
    bits = F.sequence(F.lit(0), F.lit(WORD_BITS - 1))
    return F.transform(bits, lambda s: _total(pairs, lambda x: _shift(x, s).bitwiseAND(F.lit(PAIR_MASK))))


def wrapped(lane: Column) -> Column:
    """A sign sum modulo 2**16, as a signed number."""
    return ((lane + F.lit(HALF_LANE)).bitwiseAND(F.lit(LANE_MASK)) - F.lit(HALF_LANE)).cast("smallint")


def with_sums(df: DataFrame, sums: dict[str, str]) -> DataFrame:
    """Adds, per (column of sums: column of paragraphs), the struct (words,
    signs).  Steps are columns of their own, so each is computed once."""
    keep = [c for c in df.columns if c not in sums.values()]
    df = df.select(*keep, *[F.transform(F.col(p), lambda x: F.sha2(x, 256)).alias(out) for out, p in sums.items()])
    pairs = [_word_pairs(F.col(out), k).alias(f"{out}_{k}") for out in sums for k in range(0, WORDS, 2)]
    df = df.select(*keep, *pairs)
    counts = []
    for out in sums:
        for k in range(0, WORDS, 2):
            p = F.col(f"{out}_{k}")
            counts += [
                (_total(p, lambda x: x.bitwiseAND(F.lit(WORD_MASK)))).alias(f"{out}_w{k}"),
                (_total(p, lambda x: _shift(x, WORD_BITS))).alias(f"{out}_w{k + 1}"),
            ]
        for k in range(0, SIGN_WORDS, 2):  # per bit, the counts of two words in one number
            counts.append(_bit_counts(F.col(f"{out}_{k}")).alias(f"{out}_c{k}"))
        counts.append(F.size(f"{out}_0").cast("long").alias(f"{out}_n"))
    df = df.select(*keep, *counts)

    def signs(out: str) -> Column:
        n, parts = F.col(f"{out}_n"), []
        for k in range(0, SIGN_WORDS, 2):
            both = F.col(f"{out}_c{k}")
            parts.append(F.transform(both, lambda c: wrapped(c.bitwiseAND(F.lit(WORD_MASK)) * 2 - n)))
            parts.append(F.transform(both, lambda c: wrapped(_shift(c, WORD_BITS) * 2 - n)))
        return F.concat(*parts)

    def words(out: str) -> Column:
        return F.array(*[F.col(f"{out}_w{k}").bitwiseAND(F.lit(WORD_MASK)) for k in range(WORDS)])

    return df.select(*keep, *[F.struct(words(out).alias("words"), signs(out).alias("signs")).alias(out) for out in sums])


def _combined(a: Column, b: Column, sign: int) -> Column:
    words = F.zip_with(a["words"], b["words"], lambda x, y: (x + y * sign).bitwiseAND(F.lit(WORD_MASK)))
    signs = F.zip_with(a["signs"], b["signs"], lambda x, y: wrapped(x.cast("long") + y.cast("long") * sign))
    return F.struct(words.alias("words"), signs.alias("signs"))


def inserted(sums: Column, more: Column) -> Column:
    """The sums of a document after paragraphs with the sums ``more`` came in."""
    return _combined(sums, more, 1)


def deleted(sums: Column, gone: Column) -> Column:
    """The sums of a document after paragraphs with the sums ``gone`` went."""
    return _combined(sums, gone, -1)


def fingerprint(sums: Column) -> Column:
    """Eight words of 8 and 128 sign sums of 4 hex digits."""
    words = F.transform(sums["words"], lambda x: F.lpad(F.lower(F.hex(x)), 8, "0"))
    signs = F.transform(sums["signs"], lambda x: F.lpad(F.lower(F.hex(x.cast("long").bitwiseAND(F.lit(LANE_MASK)))), 4, "0"))
    return F.concat(F.array_join(words, ""), F.array_join(signs, ""))


def likeness(a: Column, b: Column) -> Column:
    """Of two arrays of sign sums: 1 for equal ones, otherwise one minus the
    squared length of the difference over the sum of the squared lengths, 0 at
    least."""
    square = lambda v: _total(v, lambda x: x.cast("long") * x.cast("long"))
    apart = square(F.zip_with(a, b, lambda x, y: wrapped(x.cast("long") - y.cast("long"))))
    return F.when(a == b, F.lit(1.0)).otherwise(F.greatest(F.lit(0.0), 1 - apart / (square(a) + square(b))))


def in_order(rows: DataFrame) -> DataFrame:
    """(row key, doc_id, n_chars, i): the place of every row by id (null ids
    last), then row key.  Rows are range-partitioned; only the number of rows
    per partition is collected."""
    narrow = rows.select(ROW, "doc_id", F.char_length("text").cast("long").alias("n_chars"))
    order = [F.col("doc_id").asc_nulls_last(), F.col(ROW)]
    placed = shared(
        shared(narrow).repartitionByRange(*order).sortWithinPartitions(*order).withColumn("place", F.monotonically_increasing_id())
    )
    part = F.shiftright("place", PLACE_BITS)
    offsets, total = [], 0
    for p, n in sorted(tuple(r) for r in placed.groupBy(part.alias("part")).count().collect()):
        offsets.append((p, total))
        total += n
    starts = rows.sparkSession.createDataFrame(offsets, "part long, first long")
    return (
        placed.withColumn("part", part)
        .join(F.broadcast(starts), "part")
        .select(ROW, "doc_id", "n_chars", (F.col("first") + F.col("place").bitwiseAND(F.lit((1 << PLACE_BITS) - 1))).alias("i"))
    )


def with_next(rows: DataFrame) -> DataFrame:
    """(row key, doc_id, n_chars, text, next row key, head): every row with the
    first floor(n_chars / 4) code points of the next document's text.  Texts
    are shuffled once, by row key, and meet a narrow table of places there."""
    order = shared(in_order(rows))
    n = order.count()
    following = order.select(F.expr(f"pmod(i - 1, {max(n, 1)})").alias("i"), F.col(ROW).alias("next_row"))
    wanted = order.join(following, "i").select(
        F.col(ROW).alias("for_row"), "doc_id", "n_chars", F.col("next_row").alias(ROW), F.floor(F.col("n_chars") / 4).cast("int").alias("take")
    )
    texts = rows.select(ROW, "text")
    heads = texts.join(wanted, ROW).select(
        F.col("for_row").alias(ROW), "doc_id", "n_chars", F.col(ROW).alias("next_row"), F.substring("text", 1, F.col("take")).alias("head")
    )
    return texts.join(heads, ROW)


def fingerprint_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next.

    The edited text has the last floor(n_chars / 4) code points replaced by the
    first as many (or all) of the next document: ids ascending, null ids last,
    rows of one id by row key, after the last row the first.  Its fingerprint is
    the text's with the paragraphs after the cut deleted and the new ones
    inserted.  Null and empty texts have no paragraphs, all sums are zero; they
    are alike to each other (1) and to nothing else (0).  An empty table gives
    an empty result; other columns are ignored.
    """
    rows = keyed_texts(docs, id_col, text_col)
    kept = F.substring("text", F.lit(1), (F.col("n_chars") - F.floor(F.col("n_chars") / 4)).cast("int"))
    edits = (
        with_next(rows)
        .withColumn("kept", kept)
        .select(
            ROW,
            "doc_id",
            "n_chars",
            "next_row",
            F.concat("kept", "head").alias("edited"),
            paragraphs(F.col("text")).alias("old"),
            F.greatest(F.size(paragraphs(F.col("kept"))) - 1, F.lit(0)).alias("common"),
        )
    )
    # The paragraphs before the one that holds the cut are in both texts.
    split = edits.select(
        ROW,
        "doc_id",
        "n_chars",
        "next_row",
        F.sha2("edited", 256).alias("edited_sha256"),
        "old",
        F.slice("old", F.col("common") + 1, F.size("old")).alias("out"),
        F.expr("common").alias("common"),
        paragraphs(F.col("edited")).alias("new"),
    ).withColumn("into", F.slice("new", F.col("common") + 1, F.size("new")))
    summed = with_sums(split.drop("new", "common"), {"own": "old", "gone": "out", "came": "into"})
    sums = shared(
        summed.select(
            ROW, "doc_id", "n_chars", "next_row", "edited_sha256", "own", inserted(deleted(F.col("own"), F.col("gone")), F.col("came")).alias("edited")
        )
    )
    following = sums.select(F.col(ROW).alias("next_row"), F.col("own.signs").alias("next_signs"))
    return sums.join(following, "next_row").select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        fingerprint(F.col("own")).alias("fingerprint"),
        fingerprint(F.col("edited")).alias("edited_fingerprint"),
        likeness(F.col("own.signs"), F.col("edited.signs")).alias("near_edited"),
        likeness(F.col("own.signs"), F.col("next_signs")).alias("near_next"),
    )


def _hex_sums(table: str) -> str:
    """SQL: fingerprint and sign sums of every (doc_id, t) of a table."""
    return f"""
  SELECT doc_id, coalesce(words, repeat('0', {8 * WORDS})) || coalesce(hexes, repeat('0', {4 * SIGN_WORDS * WORD_BITS})) AS fingerprint,
         coalesce(signs, list_transform(range({SIGN_WORDS * WORD_BITS}), lambda x: 0::BIGINT)) AS signs
  FROM {table}
  LEFT JOIN (
    SELECT doc_id, string_agg(printf('%08x', w), '' ORDER BY k) AS words
    FROM (SELECT doc_id, k, sum(('0x' || substr(h, 8 * k + 1, 8))::BIGINT)::BIGINT & {WORD_MASK} AS w FROM {table}_p, range({WORDS}) r(k) GROUP BY doc_id, k)
    GROUP BY doc_id
  ) USING (doc_id)
  LEFT JOIN (
    SELECT doc_id, string_agg(printf('%04x', s & {LANE_MASK}), '' ORDER BY k) AS hexes, list(s ORDER BY k) AS signs
    FROM (
      SELECT doc_id, k, ((sum(2 * ((('0x' || substr(h, 8 * (k // {WORD_BITS}) + 1, 8))::BIGINT >> (k % {WORD_BITS})) & 1) - 1)::BIGINT + {HALF_LANE}) & {LANE_MASK}) - {HALF_LANE} AS s
      FROM {table}_p, range({SIGN_WORDS * WORD_BITS}) r(k) GROUP BY doc_id, k
    ) GROUP BY doc_id
  ) USING (doc_id)"""


def _paragraphs(table: str) -> str:
    return rf"""
  SELECT doc_id, sha256(p) AS h
  FROM (SELECT doc_id, trim(unnest(string_split(regexp_replace(t, '([.!?])[\x20\x09-\x0D]+', E'\\1\n', 'g'), chr(10))), E' \t\n\x0b\x0c\r') AS p FROM {table})
  WHERE p <> ''"""


def _likeness(a: str, b: str) -> str:
    square = "list_sum(list_transform({v}, lambda x: x * x))"
    apart = f"list_transform(list_zip({a}, {b}), lambda z: ((z[1] - z[2] + {HALF_LANE}) & {LANE_MASK}) - {HALF_LANE})"
    return f"CASE WHEN {a} = {b} THEN 1.0::DOUBLE ELSE greatest(0.0::DOUBLE, 1 - {square.format(v=apart)}::DOUBLE / ({square.format(v=a)} + {square.format(v=b)})::DOUBLE) END"


ORACLE = f"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n,
         coalesce(lead(doc_id) OVER (ORDER BY doc_id), min(doc_id) OVER ()) AS next_id
  FROM documents
), e AS (
  SELECT d.doc_id, d.n, d.next_id, left(d.t, (d.n - d.n // 4)::INTEGER) || left(x.t, (d.n // 4)::INTEGER) AS t
  FROM d JOIN d x ON x.doc_id = d.next_id
), d_p AS ({_paragraphs("d")}
), e_p AS ({_paragraphs("e")}
), df AS ({_hex_sums("d")}
), ef AS ({_hex_sums("e")}
)
SELECT e.doc_id, e.n AS n_chars, sha256(e.t) AS edited_sha256, df.fingerprint, ef.fingerprint AS edited_fingerprint,
       {_likeness("df.signs", "ef.signs")} AS near_edited, {_likeness("df.signs", "nf.signs")} AS near_next
FROM e JOIN df USING (doc_id) JOIN ef USING (doc_id) JOIN df nf ON nf.doc_id = e.next_id
"""
