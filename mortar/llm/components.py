"""Connected components of an edge table, by alternating star steps.

Large-star links every larger neighbour of a node to the smallest node it
knows; small-star does the same with the smaller ones.  Both are a partial
aggregate and a join on the node, so a node with very many edges is never
gathered; every round is written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .text import cut


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star step over (u, v) pairs; every node is linked to its least neighbour."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    seen = both if large else both.where(F.col("v") < F.col("u"))
    least = seen.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    kept = (both.where(F.col("v") > F.col("u")) if large else seen)
    moved = kept.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    if not large:
        moved = moved.union(least.select("u", F.col("m").alias("v")))
    return moved.where(F.col("u") != F.col("v")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, label): the smallest node of each edge end's component; edges are (u, v) longs."""
    now = cut(edges.where(F.col("u") != F.col("v")).select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    mark = None
    while True:
        new = cut(_star(_star(now, True), False))
        state = new.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(state) == mark:
            break
        now, mark = new, tuple(state)
    # a star around the least node: every other node has one edge to it
    return now.select(F.col("u").alias("node"), F.col("v").alias("label")).union(
        now.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())
