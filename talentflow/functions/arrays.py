"""Array helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def explode_rows(df: DataFrame, array: Column, alias: str, keep: list[str] | None = None) -> DataFrame:
    """One row per element of ``array`` (NULL and empty arrays give none),
    like ``explode``.

    Written as ``posexplode_outer`` plus a filter on the position: Spark infers
    a ``size(array) > 0`` filter for a plain ``explode`` and pushes it below
    the projection that computes the array, which evaluates an expensive
    array expression twice; the outer form infers nothing.
    """
    cols = list(df.columns if keep is None else keep)
    return (
        df.select(*cols, F.posexplode_outer(array).alias("_pos", alias))
        .filter(F.col("_pos").isNotNull())
        .drop("_pos")
    )
