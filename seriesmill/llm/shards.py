"""Reproducible shuffle into shards by a Feistel permutation with cycle walking.

Global row numbers 0..n-1 are permuted by an alternating Feistel network over a grid of
about sqrt(n) x sqrt(n) cells; a number that lands on one of the few cells beyond n is
permuted again until it falls inside.  Shard and slot follow from the permuted number, so
both can be computed from a row number alone.  Only DataFrame operations.

Defined results
    rows are numbered by the order columns (nulls first), so rows equal in them are
    exchangeable; shard sizes differ by one row at most and slots have no gaps; fewer rows
    than shards leave the last shards empty; an empty table stays empty; further columns are kept.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from seriesmill.llm.common import numbered, unused

ROUNDS = 6
#: Walks longer than this do not happen: each step leaves the range with a chance below 1/60.
WALK = 64


def permuted(number: Column, n: int, seed: int) -> Column:
    """The place of row ``number`` among ``n`` rows: a bijection of 0..n-1 fixed by ``seed``."""
    wide = max(1, math.isqrt(max(n - 1, 0)) + 1)
    high = max(1, -(-n // wide))

    def once(x: Column) -> Column:
        start = F.struct(F.pmod(x, F.lit(wide)).alias("l"), F.floor(x / F.lit(wide)).cast("long").alias("r"))

        def turn(state: Column, k: Column) -> Column:
            left, right = state["l"], state["r"]
            even = F.pmod(left + F.pmod(F.xxhash64(right, k, F.lit(seed)), F.lit(wide)), F.lit(wide))
            odd = F.pmod(right + F.pmod(F.xxhash64(left, k, F.lit(seed)), F.lit(high)), F.lit(high))
            return F.struct(F.when(k % 2 == 0, even).otherwise(left).alias("l"),
                            F.when(k % 2 == 1, odd).otherwise(right).alias("r"))

        return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, turn, lambda s: s["l"] + s["r"] * F.lit(wide))

    outside = wide * high - n  # no walk can be longer than the cells outside
    steps = min(outside, WALK)
    first = once(number)
    if steps == 0:
        return first
    walked = F.aggregate(F.sequence(F.lit(1), F.lit(steps)), first,
                         lambda at, _: F.when(at >= n, once(at)).otherwise(at))
    return F.when(walked < n, walked).otherwise(F.raise_error(F.lit("cycle walk too long")).cast("long"))


def sharded(df: DataFrame, order: Sequence[Column], shards: int, seed: int = 17) -> DataFrame:
    """All rows and columns of ``df`` with ``shard`` (from 0) and ``slot`` (from 0 in each shard)."""
    row, place, shard, slot = *unused(df.columns, "row_number", "place"), "shard", "slot"
    rows, n = numbered(df, order, row)
    return (rows.withColumn(place, permuted(F.col(row), n, seed))
            .select(*[c for c in df.columns if c not in (shard, slot)],
                    F.pmod(F.col(place), F.lit(shards)).cast("int").alias(shard),
                    F.floor(F.col(place) / F.lit(shards)).cast("long").alias(slot)))


def write_shards(placed: DataFrame, path: str) -> None:
    """One folder per shard with its rows by slot; large shards are cut into several files by size settings."""
    placed.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
