"""Connected components of an edge table by alternating star contraction.

Each round hangs every node on the smallest node it knows (large star: the neighbours above it;
small star: itself and those below). Every step aggregates with partial sums and joins, so a hub's
edges are never gathered; AQE splits a hub's join. Rounds are written to the shared folder, which
cuts the lineage, and end when a round changes nothing; their number grows with the logarithm of the
longest path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import settle


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min(F.least("u", "v")).alias("m"))
    return both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    low = edges.groupBy("u").agg(F.min("v").alias("m"))
    hung = edges.join(low, "u")
    return hung.select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m").alias("v")))


def components(edges: DataFrame) -> DataFrame:
    """node, component (the smallest node reachable) for each node of the edges (a, b), in any order."""
    now = settle(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                 .where("u <> v").distinct(), "edges")
    mark = F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
    seen = None
    while True:
        state = tuple(now.agg(F.count("*"), mark).first())
        if state == seen or not state[0]:
            break
        seen = state
        now = settle(_small_star(_large_star(now)).where("u <> v").distinct(), "edges")
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
