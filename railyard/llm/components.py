"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from railyard.plans.checkpoints import cut


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node's larger neighbours point to its least neighbour (or itself)."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
    return both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours point to the least of these; a > b throughout."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    met = edges.join(least, "a")
    return met.filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
        least.select("a", F.col("m").alias("b"))
    ).distinct()


def stars(edges: DataFrame) -> DataFrame:
    """(a, b): every node of a component of several nodes but the least points to the least.

    ``edges`` are pairs (a, b) of different nodes in either order. Each round is written; the
    number of rounds follows the logarithm of the longest path.
    """
    now = cut(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    state = None
    while True:
        new = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if new == state or not new[0]:
            return now
        state = new
        now = cut(_small_star(_large_star(now)))
