"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ._work import Work


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star step over edges (u, v): hook neighbours to the smallest neighbour.

    Large star moves the larger neighbours of u, small star u and its smaller
    neighbours.  The minimum is a partial/final aggregate and the join is on u,
    so a hub's edges are split by the skew join, never gathered.
    """
    if large:
        sides = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        sides = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = sides.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    near = sides.join(low, "u")
    if large:
        moved = near.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        moved = near.select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m").alias("v")))
    return moved.where("u <> v").distinct()


def connected_components(work: Work, edges: DataFrame, tag: str = "cc") -> DataFrame:
    """Return (vertex, component) for every vertex of ``edges(u, v)`` of type long.

    ``component`` is the smallest vertex reachable.  Self loops and repeated
    edges are allowed, NULL ends are ignored, no edges give an empty result.
    Each round is written as a table; rounds grow with the logarithm of the
    longest path.
    """
    edges = edges.where("u is not null and v is not null and u <> v").select("u", "v").distinct()
    now, k, seen = work.table(edges, f"{tag}0"), 0, None
    while True:
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(mark) == seen or mark[0] == 0:
            return now.select(F.col("u").alias("vertex"), F.col("v").alias("component")).union(
                now.select("v", "v").distinct())
        seen = tuple(mark)
        k += 1
        new = work.table(_star(_star(now, True), False), f"{tag}{k}")
        work.drop(f"{tag}{k - 1}")
        now = new
