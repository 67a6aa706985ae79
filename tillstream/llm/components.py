"""Connected components of a graph given as pairs, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstream.session import settle


def _smallest(pairs: DataFrame) -> DataFrame:
    """For each pair (u, v), the smallest neighbour of u, or u itself if smaller; counted map-side,
    so that a node with very many neighbours makes no large group."""
    least = pairs.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    return pairs.join(least, "u")


def components(pairs: DataFrame) -> DataFrame:
    """``pairs`` with columns a and b: each node (but single ones) with ``label``, the smallest node
    that it is connected to. Each step is settled; the number of steps is logarithmic."""
    pairs = settle(pairs.filter("a <> b").select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "pairs")
    before = None
    while True:
        # Large star: larger neighbours move to the smallest one.
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _smallest(both).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u <> v").distinct()
        # Small star: smaller neighbours, and the node itself, move to the smallest one.
        small = _smallest(large)
        moved = small.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        own = small.select("u", F.col("m").alias("v"))
        pairs = settle(moved.unionByName(own).distinct(), "stars")
        # A star forest stays as it is; the sum of hashes tells.
        state = pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            return pairs.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(
                pairs.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())
        before = state
