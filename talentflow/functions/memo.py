"""Per-session memoisation of Column expressions.

Building a large expression tree from Python costs one Python->JVM call per
node (thousands for the normalisation mappings).  The trees depend only on
configuration, not on the data, and a Column can be reused by any DataFrame
of the same SparkContext, so builders that take hashable arguments are
memoised per SparkContext.
"""

from __future__ import annotations

import functools

from pyspark import SparkContext


def per_context(fn):
    cache: dict = {}

    @functools.wraps(fn)
    def wrapper(*args):
        sc = SparkContext._active_spark_context
        key = (id(sc), sc.applicationId if sc is not None else None, args)
        if key not in cache:
            if len(cache) > 256:
                cache.clear()
            cache[key] = fn(*args)
        return cache[key]

    wrapper.cache_clear = cache.clear  # type: ignore[attr-defined]
    return wrapper


def freeze(catalog) -> tuple:
    """A hashable form of a catalog mapping."""
    return tuple((k, tuple(v)) for k, v in catalog.items())
