"""Exact interpolated quantiles without a per-group sort or value map.

1. A mergeable sketch gives, per group and probability, a value bracket that surely
   holds the wanted order statistics.
2. One pass counts the values below each bracket; only values inside a bracket (about
   4/accuracy of the group) are collected by value, pre-aggregated, and ranked.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from seriesmill.plans.materialize import sized


def exact_quantiles(df: DataFrame, groups: Sequence[str], value: str, probs: Sequence[float],
                    accuracy: int = 10_000) -> DataFrame:
    """Columns ``groups..., p, q``: the linearly interpolated quantile of non-NULL values."""
    groups = list(groups)
    if not groups:
        return exact_quantiles(df.withColumn("_all", F.lit(0)), ["_all"], value, probs, accuracy).drop("_all")
    data = df.where(F.col(value).isNotNull()).select(*groups, F.col(value).cast("double").alias("_v"))
    slack = 2.0 / accuracy
    low = [max(0.0, p - slack) for p in probs]
    high = [min(1.0, p + slack) for p in probs]
    sketch = data.groupBy(*groups).agg(
        F.percentile_approx("_v", low, accuracy).alias("_lo"),
        F.percentile_approx("_v", high, accuracy).alias("_hi"),
        F.count(F.lit(1)).alias("_n"),
        F.min("_v").alias("_min"), F.max("_v").alias("_max"),
    )
    # a small group (at most ten values per unit of sketch error) is its own bracket
    whole = F.col("_n") <= 10 * accuracy
    # one row per group: the wanted bracket per probability
    brackets = sized(sketch.select(
        *groups, "_n",
        F.array(*[
            F.struct(
                F.lit(float(p)).alias("p"),
                (F.lit(float(p)) * (F.col("_n") - 1)).alias("rank"),
                (F.col("_min") if low[i] == 0.0 else F.when(whole, F.col("_min")).otherwise(F.col("_lo")[i])).alias("lo"),
                (F.col("_max") if high[i] == 1.0 else F.when(whole, F.col("_max")).otherwise(F.col("_hi")[i])).alias("hi"))
            for i, p in enumerate(probs)
        ]).alias("_want"),
    ))
    joined = data.join(brackets, groups)
    below = joined.groupBy(*groups).agg(*[
        F.sum(F.when(F.col("_v") < F.col("_want")[i]["lo"], 1).otherwise(0)).alias(f"_b{i}")
        for i in range(len(probs))
    ])
    below = below.select(*groups, F.posexplode(F.array(*[f"_b{i}" for i in range(len(probs))]))
                         .alias("_which", "_below"))
    inside = joined.select(
        *groups, "_v",
        F.explode(F.filter(
            F.transform("_want", lambda w, i: F.struct(i.alias("_which"), w.alias("w"))),
            lambda e: (F.col("_v") >= e["w"]["lo"]) & (F.col("_v") <= e["w"]["hi"]))).alias("e"),
    ).select(*groups, "_v", F.col("e._which").alias("_which"),
             F.col("e.w.p").alias("p"), F.col("e.w.rank").alias("_rank"))
    counted = (inside.groupBy(*groups, "_which", "p", "_rank", "_v")
               .agg(F.count(F.lit(1)).alias("_c"))
               .join(sized(below), [*groups, "_which"]))
    order = Window.partitionBy(*groups, "_which").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    ranked = counted.withColumn("_upto", F.col("_below") + F.sum("_c").over(order))
    at = lambda r: F.max(F.when((F.col("_upto") > r) & (F.col("_upto") - F.col("_c") <= r), F.col("_v")))
    lo_rank, hi_rank = F.floor("_rank"), F.ceil("_rank")
    missed = F.raise_error(F.lit("a rank lies outside its bracket")).cast("double")
    return (ranked.groupBy(*groups, "p", "_rank")
            .agg(F.coalesce(at(lo_rank), missed).alias("_a"), F.coalesce(at(hi_rank), missed).alias("_b"))
            .select(*groups, "p",
                    (F.col("_a") + (F.col("_b") - F.col("_a"))
                     * (F.col("_rank") - F.floor("_rank"))).alias("q")))


def quantile_table(df: DataFrame, groups: Sequence[str], value: str,
                   probs: dict[str, float], accuracy: int = 10_000) -> DataFrame:
    """The same, one column per named probability."""
    long = exact_quantiles(df, groups, value, list(probs.values()), accuracy)
    return long.groupBy(*groups).agg(*[
        F.max(F.when(F.col("p") == F.lit(float(p)), F.col("q"))).alias(name)
        for name, p in probs.items()
    ])


def unpivot(df: DataFrame, ids: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Long form ``ids..., feature, value`` of numeric columns (no shuffle)."""
    return df.select(*ids, *[F.col(c).cast("double").alias(c) for c in columns]).unpivot(
        list(ids), list(columns), "feature", "value")
