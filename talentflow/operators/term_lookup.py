"""Whole-word term extraction with catalogs of any size.

:func:`talentflow.functions.terms.extract_terms` searches a text once per name,
which suits a catalog of dozens.  Here the catalog is a table (name, variant),
and every text is read once, whatever its length.

A text is cut into atoms: a run of word characters, or one other character.
A variant stands somewhere as a whole word exactly where its atoms, case folded,
are consecutive atoms of the text: word edges of a variant must be edges of a
run, and an edge that is not a word character must touch a word character of
the text.  So the runs of consecutive atoms, of the lengths that the catalog
has, are looked up in a hash table of variants, map-side where the catalog is
small enough to broadcast.  Only hits are shuffled then.
"""

from __future__ import annotations

import uuid
from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..catalogs import Catalog, validate
from ..functions.patterns import WORD_CLASS
from ..session import scratch_path, staged

# A catalog up to this many variants and bytes is broadcast; a larger one meets
# the texts in a shuffled join on the variant.
BROADCAST_ROWS, BROADCAST_BYTES = 500_000, 32 << 20
ATOM = f"{WORD_CLASS}+|[^{WORD_CLASS[1:]}"
WORD_START = f"^{WORD_CLASS}"
# The combining iota is no word character but folds to a letter; it stays itself.
COMBINING_IOTA = 0x345


@cache
def _fold_tables() -> tuple[str, str]:
    """Characters that case folding changes, and what each becomes: the lower
    case of its upper case, one character for one."""
    before, after = [], []
    for code in range(0x80, 0x110000):
        ch = chr(code)
        upper = ch.upper() if len(ch.upper()) == 1 else ch
        folded = upper.lower()[0]
        if folded != ch and code != COMBINING_IOTA:
            before.append(ch)
            after.append(folded)
    ascii_upper = [chr(c) for c in range(ord("A"), ord("Z") + 1)]
    return "".join(ascii_upper + before), "".join([c.lower() for c in ascii_upper] + after)


def fold_case(text: Column) -> Column:
    """``text`` with every character in one case, length kept."""
    before, after = _fold_tables()
    ascii_only = F.octet_length(text) == F.char_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, before, after))


def atoms(text: Column) -> Column:
    """The case-folded atoms of ``text`` (``[]`` if null or empty)."""
    return F.regexp_extract_all(fold_case(F.coalesce(text, F.lit(""))), F.lit(ATOM), F.lit(0))


def catalog_frame(spark: SparkSession, catalog: Catalog) -> DataFrame:
    """A literal catalog as a table (name, variant)."""
    rows = [(name, v) for name, variants in validate(catalog).items() for v in variants]
    return spark.createDataFrame(rows, "name string, variant string")


def _prepared(catalog: DataFrame) -> DataFrame:
    """(name, term, head, n_atoms, before, after): a folded variant of a name, its
    first atom, whether a word character must precede or follow it.  Repeated rows
    count once."""
    own = catalog.filter((F.col("name") != "") & (F.col("variant") != "")).select("name", atoms(F.col("variant")).alias("a"))
    rows = own.select(
        "name",
        F.array_join("a", "").alias("term"),
        F.element_at("a", 1).alias("head"),
        F.size("a").alias("n_atoms"),
        (~F.element_at("a", 1).rlike(WORD_START)).alias("before"),
        (~F.element_at("a", -1).rlike(WORD_START)).alias("after"),
    )
    return staged(rows.distinct())


def term_mentions(rows: DataFrame, key: str, text: str, catalog: DataFrame) -> DataFrame:
    """Distinct (``key``, name): the names with a variant that stands in ``text``
    as a whole word, in any case.

    ``catalog`` has the columns name and variant; rows with a null or empty one
    are ignored.  Null and empty texts mention nothing.  Rows that share a key
    count as one text collection.  Equal to the regular-expression form but for
    the combining iota, which is no letter here.  The work is the number of atoms
    times the number of different lengths of the variants that an atom may open.
    """
    prepared = _prepared(catalog)
    size = prepared.agg(F.count("*").alias("n"), F.sum(F.octet_length("term") + F.octet_length("name")).alias("b")).first()
    small = size["n"] <= BROADCAST_ROWS and (size["b"] or 0) <= BROADCAST_BYTES
    a, at, n = F.col("_atoms"), F.col("_at"), F.col("_n")
    # outer, then a filter on the place: no size test is inferred that would cut every text twice
    placed = rows.select(key, atoms(F.col(text)).alias("_atoms")).select(key, "_atoms", F.posexplode_outer("_atoms").alias("_at", "_atom"))
    placed = placed.filter(at.isNotNull())
    if small:  # an atom opens runs of the lengths that variants with this first atom have
        heads = prepared.select(F.col("head").alias("_atom"), F.col("n_atoms").alias("_n")).distinct()
        prepared, opened = F.broadcast(prepared), placed.join(F.broadcast(heads), "_atom")
    else:  # and of every length there is, where that table is large too
        lengths = [r[0] for r in prepared.select("n_atoms").distinct().orderBy("n_atoms").collect()]  # at most a variant's length
        opened = placed.select("*", F.explode(F.array(*map(F.lit, lengths))).alias("_n"))
    runs = (
        opened.filter(at + n <= F.size(a))
        .select(
            key,
            F.when(n == 1, F.col("_atom")).otherwise(F.array_join(F.slice(a, at + 1, n), "")).alias("term"),
            F.get(a, at - 1).alias("_before"),
            F.get(a, at + n).alias("_after"),
        )
    )
    # null (the text's edge) fails a required neighbour
    edges = (~F.col("before") | F.coalesce(F.col("_before").rlike(WORD_START), F.lit(False))) & (
        ~F.col("after") | F.coalesce(F.col("_after").rlike(WORD_START), F.lit(False))
    )
    return runs.join(prepared, "term").filter(edges).select(key, "name").distinct()


def with_terms(rows: DataFrame, text: str, catalog: DataFrame, out: str = "terms") -> DataFrame:
    """``rows`` with ``out``: the sorted names that ``text`` mentions (``[]`` if
    none).  Rows are told apart by a key given here, so repeated rows and ids of
    any kind are rows of their own."""
    path = scratch_path(rows.sparkSession, "terms", uuid.uuid4().hex)
    rows.withColumn("_term_row", F.monotonically_increasing_id()).write.parquet(path)
    keyed = rows.sparkSession.read.parquet(path)
    found = term_mentions(keyed, "_term_row", text, catalog).groupBy("_term_row").agg(F.sort_array(F.collect_list("name")).alias("_found"))
    none = F.array().cast("array<string>")
    return keyed.join(found, "_term_row", "left").select(*rows.columns, F.coalesce("_found", none).alias(out))


def catalog_trends(rows: DataFrame, key: str, text: str, catalog: DataFrame) -> DataFrame:
    """A2 over a large catalog: how many keys mention each name (mentioned names only)."""
    return term_mentions(rows, key, text, catalog).groupBy("name").agg(F.count("*").alias("mentions_count"))
