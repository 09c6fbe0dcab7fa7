"""Connected components of an edge table, as DataFrame joins.

Every round each node points to the smallest node among itself and its
neighbours; pointers are followed by doubling to the end of their chains; then
the edges are replaced by the edges between these ends, without loops and
repeats.  Edges vanish fast (a star or a sorted chain in one round), and later
rounds join only what is left of them.  State is narrow tables, checkpointed in
the shared folder; nothing but whether a row is left reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import shared


def _pairs(edges: DataFrame) -> DataFrame:
    """Distinct edges (a, b) with a < b."""
    return shared(edges.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())


def _ends(pointers: DataFrame) -> DataFrame:
    """(node, goal): where the chain of pointers (node, goal) ends.  Goals are
    nodes too; a node that points to itself is an end."""
    while True:
        onward = pointers.select(F.col("node").alias("goal"), F.col("goal").alias("next"))
        jumped = shared(pointers.join(onward, "goal").select("node", "goal", "next"))
        pointers = jumped.select("node", F.col("next").alias("goal"))
        if not jumped.filter("goal <> next").limit(1).count():
            return pointers


def connected_components(edges: DataFrame) -> DataFrame:
    """(a, b) edges to (node, component): the smallest node of the component.

    Loops, repeated and reversed edges are allowed; an empty table gives an
    empty one.
    """
    labels = edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct()
    labels = shared(labels.select("node", F.col("node").alias("component")))
    pairs = _pairs(edges)
    while pairs.limit(1).count():
        both = pairs.select(F.col("a").alias("node"), F.col("b").alias("other")).union(pairs.select("b", "a"))
        ends = _ends(shared(both.groupBy("node").agg(F.min("other").alias("goal")).select("node", F.least("node", "goal").alias("goal"))))
        moved = pairs.join(ends.withColumnRenamed("node", "a"), "a").select(F.col("goal").alias("a"), "b")
        pairs = _pairs(moved.join(ends.withColumnRenamed("node", "b"), "b").select("a", F.col("goal").alias("b")))
        labels = shared(
            labels.join(ends.withColumnRenamed("node", "component"), "component", "left").select(
                "node", F.coalesce("goal", "component").alias("component")
            )
        )
    return labels
