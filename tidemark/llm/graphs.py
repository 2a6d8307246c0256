"""Connected components by rounds of smaller-neighbour links; nothing but counts reaches the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import store


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node links its larger neighbours to its smallest one."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("low"))
    larger = both.where(F.col("v") > F.col("u"))
    return larger.join(low, "u").where(F.col("v") != F.col("low")).select(
        F.col("v").alias("u"), F.col("low").alias("v")
    ).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node links its smaller neighbours and itself to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = down.groupBy("u").agg(F.min("v").alias("low"))
    across = down.join(low, "u").where(F.col("v") != F.col("low")).select(F.col("v").alias("u"), F.col("low").alias("v"))
    own = low.select("u", F.col("low").alias("v"))
    return across.unionByName(own).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable, for every node with an edge. ``edges``: u, v, both long.

    Alternating large-star and small-star rounds; each round's edges are stored, and the end is reached when a
    round changes nothing (compared by count and sum of the edges' hashes).
    """
    current = store(edges.where("u <> v").distinct(), "edges")
    seen = None
    while True:
        at = current.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if at["n"] == 0 or (at["n"], at["h"]) == seen:
            break
        seen = (at["n"], at["h"])
        current = store(_small_star(store(_large_star(current), "large-star")), "small-star")
    leaves = current.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return store(leaves.unionByName(roots), "components")
