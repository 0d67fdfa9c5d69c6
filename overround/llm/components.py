"""Connected components by alternating star contraction, with DataFrame operations alone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from overround.llm.shared import written


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def connected_components(edges: DataFrame, left: str, right: str) -> DataFrame:
    """(node, component) for every node of ``edges``; a component is named by its smallest node.

    Nodes can be of any one type that has an order. Each round hangs every neighbour below the
    smallest one around it (large star, then small star), so a round needs two grouped minima, which
    are aggregated before the shuffle, and equi-joins that AQE can split where one node has very many
    links. Nothing but a count and a checksum comes to the driver. The edges of each round go to shared
    storage, so a lost executor costs one round at most. Loops, repeated edges and null ends are allowed
    (null ends are no links; a loop makes its node known). An empty table gives an empty result.
    """
    a, b = F.col(left), F.col(right)
    pairs = edges.where(a.isNotNull() & b.isNotNull()).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    pairs = written(pairs.distinct(), "components")
    state = _state(pairs)
    while True:
        # Large star: the neighbours above a node move below the smallest of it and its neighbours.
        both = pairs.union(pairs.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct()
        least = both.groupBy("u").agg(F.min(F.least("u", "v")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        loops = pairs.where("u = v")
        large = large.union(loops).distinct()
        # Small star: the neighbours below a node move below the smallest of them.
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(least, "u")
        small = joined.select(F.greatest("v", "m").alias("u"), F.col("m").alias("v")).union(
            least.select("u", F.col("m").alias("v"))).distinct()
        pairs = written(small, "components")
        before, state = state, _state(pairs)
        if state == before:
            break
    roots = pairs.select(F.col("v").alias("node"), F.col("v").alias("component"))
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots).groupBy("node").agg(
        F.min("component").alias("component"))
