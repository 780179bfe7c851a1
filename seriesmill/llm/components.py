"""Connected components of a link table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from seriesmill.llm.common import forget, settle


def _stars(links: DataFrame, large: bool) -> DataFrame:
    """One step: the neighbours of each node are tied to the least of them.

    The least neighbour is a grouped minimum (combined before the shuffle) that is joined back,
    so the many neighbours of a hub are never gathered; AQE splits a hub's share of the join.
    """
    away = links.where("a <> b")
    both = away.unionByName(away.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else (
        away.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("n"), F.least("a", "m").alias("m"))
    met = both.join(least, F.col("a") == F.col("n"))
    if large:  # only larger neighbours move
        moved = met.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:  # smaller neighbours and the node itself move
        moved = met.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            least.select(F.col("n").alias("a"), F.col("m").alias("b")))
    return moved.where("a <> b").distinct()


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """``node, root`` for every node of ``links`` (``a``, ``b``); the root is the least node reachable.

    Each round is written to the shared folder and ends when it changes nothing; the number of
    rounds grows with the logarithm of the longest chain.  A link of a node to itself and
    repeated links change nothing; nulls are left out.
    """
    now = settle(links.where("a is not null and b is not null").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "links")
    mark = None
    for _ in range(rounds):
        large = settle(_stars(now, True), "large-star")
        small = settle(_stars(large, False), "small-star")
        forget(now, large)
        now = small
        seen = tuple(now.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first())
        if seen == mark:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
        mark = seen
    raise RuntimeError(f"components did not settle in {rounds} rounds")
