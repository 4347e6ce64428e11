"""Connected components by alternating large-star and small-star steps.

Every step is a minimum per node (combined before the shuffle) and a join on
the node; no neighbour list is ever gathered, so a hub costs no more than its
edges.  Each round is written to the shared folder, which cuts the lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retail_insights.llm.common import materialize


def _star(edges: DataFrame) -> DataFrame:
    """``edges`` with the least neighbour (or the node itself) as ``m``."""
    least = edges.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return edges.join(least, "u")


def connected_components(edges: DataFrame) -> DataFrame:
    """``(u, v)`` edges of comparable nodes -> ``(node, root)`` for every node
    of an edge; the root is the least node of its component."""
    current = materialize(
        edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(),
        "edges")
    state = None
    while True:
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _star(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = _star(large.distinct())
        following = small.select("u", F.col("m").alias("v")).unionByName(
            small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))).distinct()
        current = materialize(following, "stars")
        now = current.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            return current.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                current.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        state = now
