"""Connected components by alternating large and small stars.

Every step moves edges towards the smallest node they reach, so chains shrink
fast. Edges are written to the shared folder after each round: a lost executor
costs no more than a round. Minima are taken with map-side combine and joined
back from a stored table, so a hub is not one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..sources.stored import stored


def _lowest_neighbour(pairs: DataFrame, name: str) -> DataFrame:
    lowest = pairs.groupBy("u").agg(F.min("v").alias("m"))
    return stored(lowest.select("u", F.least("u", "m").alias("m")), f"{name}-lowest")


def _large_star(edges: DataFrame, name: str) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    near = both.join(_lowest_neighbour(both, name), "u")
    return near.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame, name: str) -> DataFrame:
    """``v`` is the smaller node of every edge here."""
    near = edges.join(_lowest_neighbour(edges, name), "u")
    to_lowest = near.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return to_lowest.unionByName(near.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """Every node of ``edges`` (u, v) with the smallest node of its component: node, root.

    Loops, repeated edges and either direction are allowed. No edges give an
    empty result.
    """
    edges = stored(edges.where("u <> v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), name)
    before = None
    while True:
        starred = stored(_large_star(edges, name).distinct(), name)
        edges = stored(_small_star(starred, name), name)
        # A sum over all edges tells whether the round changed any.
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
