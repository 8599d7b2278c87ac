"""Connected components of a link table, by joins only.

Alternates two steps until nothing changes: every node hooks its larger
neighbours, then its smaller ones, to the smallest node it knows.  Each step is
one aggregation (combined before the shuffle, so a hub costs one row per task)
and one join back, which adaptive execution can split at a hub.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import store


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Rows ``(node, root)`` for every node of ``links``; root is the smallest.

    Links with a null end or from a node to itself are ignored, repeated ones
    count once, and an empty table gives an empty result.
    """
    edges = store(links.select(F.least(a, b).alias("lo"), F.greatest(a, b).alias("hi"))
                  .where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("lo") < F.col("hi")))
                  .distinct(), "links")
    while True:
        larger = _hook(edges, up=True)
        smaller = store(_hook(larger, up=False), "links")
        changed = (smaller.join(edges, ["lo", "hi"], "left_anti").limit(1).count()
                   or edges.join(smaller, ["lo", "hi"], "left_anti").limit(1).count())
        edges = smaller
        if not changed:
            break
    roots = edges.groupBy(F.col("hi").alias("node")).agg(F.min("lo").alias("root"))
    return roots.union(edges.select(F.col("lo").alias("node"), F.col("lo").alias("root")).distinct())


def _hook(edges: DataFrame, up: bool) -> DataFrame:
    """One step: link each node's larger (up) or smaller neighbours to its minimum."""
    if up:
        both = edges.select(F.col("lo").alias("u"), F.col("hi").alias("v")).union(
            edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        moved = both.where("v > u").join(least, "u").select(F.col("v"), F.col("m"))
    else:
        down = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v"))
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        moved = (down.join(least, "u").select("v", "m")
                 .union(least.select(F.col("u").alias("v"), "m")))
    return (moved.where("v != m")
            .select(F.least("v", "m").alias("lo"), F.greatest("v", "m").alias("hi")).distinct())
