"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed


def _stars(edges: DataFrame) -> DataFrame:
    """One large and one small star over (u, v) with u > v; neighbour minima are pre-aggregated, so a hub is no hot group."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    # Larger neighbours of u move to the least of u and its neighbours.
    large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.least("u", "m").alias("v")).where("u != v").distinct()
    down = large.groupBy("u").agg(F.min("v").alias("m"))
    # u and its smaller neighbours move to the least of these.
    moved = large.join(down, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(down.select("u", F.col("m").alias("v")))
    return moved.where("u != v").distinct()


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, root): every linked node with the least node that it reaches; links has columns u, v of one orderable type.

    Each round's edges are checkpointed; their number and hash sum tell when nothing has changed.
    """
    edges = checkpointed(links.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    of = lambda e: e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    state = of(edges)
    for _ in range(rounds):
        if state[0] == 0:
            break
        edges = checkpointed(_stars(edges))
        before, state = state, of(edges)
        if before == state:
            break
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
