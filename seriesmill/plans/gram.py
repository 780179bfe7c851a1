"""Pairwise correlations in one scan: block sums per Arrow batch, combined by Spark."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

_SCHEMA = "a int, b int, n double, sa double, sb double, saa double, sbb double, sab double"


def correlations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``a, b, r`` for every column pair (a before b), over rows where both are present.

    Each task reduces its rows to one matrix product per sum, so columns^2 numbers leave a
    task however many rows it read.
    """
    columns = list(columns)
    # sums are taken around the column means, which keeps them small (one number per column)
    means = df.agg(*[F.avg(F.col(c).cast("double")).alias(f"m{k}") for k, c in enumerate(columns)]).first()
    centre = np.array([0.0 if v is None else v for v in means], dtype=float)
    upper_a, upper_b = np.triu_indices(len(columns), 1)

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = None
        for batch in batches:
            x = batch.to_numpy(dtype=float) - centre
            present = np.isfinite(x)
            x = np.where(present, x, 0.0)
            m = present.astype(float)
            part = np.stack([m.T @ m, x.T @ m, m.T @ x, (x * x).T @ m, m.T @ (x * x), x.T @ x])
            total = part if total is None else total + part
        if total is not None:
            flat = total[:, upper_a, upper_b]
            yield pd.DataFrame({"a": upper_a.astype("int32"), "b": upper_b.astype("int32"), **{
                name: flat[k] for k, name in enumerate(("n", "sa", "sb", "saa", "sbb", "sab"))}})

    partial = df.select(*[F.col(c).cast("double").alias(c) for c in columns]).mapInPandas(sums, _SCHEMA)
    total = partial.groupBy("a", "b").agg(*[F.sum(c).alias(c) for c in ("n", "sa", "sb", "saa", "sbb", "sab")])
    n = F.col("n")
    va = n * F.col("saa") - F.col("sa") * F.col("sa")
    vb = n * F.col("sbb") - F.col("sb") * F.col("sb")
    # what is left of the second moment below rounding is no variance: a column that is constant over the shared rows has no r
    spread = lambda v, square: F.when(v > 1e-12 * n * F.col(square), F.sqrt(v))
    r = F.try_divide(n * F.col("sab") - F.col("sa") * F.col("sb"), spread(va, "saa") * spread(vb, "sbb"))
    names = F.array(*[F.lit(c) for c in columns])
    return total.select(names[F.col("a")].alias("a"), names[F.col("b")].alias("b"), F.col("a").alias("_a"), F.col("b").alias("_b"), r.alias("r"))
