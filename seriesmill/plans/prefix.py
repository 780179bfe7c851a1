"""Running totals over the sorted values of one column, without a single-task sort.

Values are reduced to one row per distinct value first (so ties cannot be hot) and range
partitioned; the partition numbers are written down, each partition is summed on its own,
and a table of one row per partition carries the totals forward.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window, functions as F

from seriesmill.plans.materialize import settle


def totals_below(df: DataFrame, value: str, sums: Mapping[str, Column]) -> DataFrame:
    """Per distinct ``value``: each sum, and ``<sum>_below``, its total over smaller values."""
    distinct = df.groupBy(F.col(value)).agg(*[F.sum(e).alias(n) for n, e in sums.items()])
    placed = settle(distinct.repartitionByRange(F.col(value)).withColumn("_part", F.spark_partition_id()))
    per_part = placed.groupBy("_part").agg(*[F.sum(n).alias(f"_s_{n}") for n in sums])
    order = Window.partitionBy(F.lit(0)).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    carry = per_part.select("_part", *[F.coalesce(F.sum(f"_s_{n}").over(order), F.lit(0)).alias(f"_k_{n}") for n in sums])
    inside = Window.partitionBy("_part").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    local = placed.withColumns({f"_w_{n}": F.coalesce(F.sum(n).over(inside), F.lit(0)) for n in sums})
    joined = local.join(carry, "_part")
    return joined.select(value, *sums, *[(F.col(f"_k_{n}") + F.col(f"_w_{n}")).alias(f"{n}_below") for n in sums])
