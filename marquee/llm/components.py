"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage


def _total(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(a, b) edges -> (node, root) with the smallest node of each component; every end of an edge is there.

    Large-star and small-star rounds in turn: every round hangs neighbours on
    smaller ones, and the number of rounds grows with the logarithm of the
    longest path.  A round is two aggregations and two joins; its edges are
    written to the shared folder, so lost executors re-read them.  Minima are
    combined before they are shuffled, so a hub is no hot group.
    """
    def both(e: DataFrame) -> DataFrame:
        return e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))

    def least(e: DataFrame) -> DataFrame:
        return e.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))

    now = stage(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "edges")
    before = None
    while (total := _total(now)) != before:
        before = total
        around = both(now)
        large = around.join(least(around), "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
        low = least(large)
        small = large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")) \
            .unionByName(low.select("a", F.col("m").alias("b")))
        now = stage(small.where("a <> b").distinct(), "edges")
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")) \
        .unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
