"""Row and column selection: tails, latest rows, alignment, finite values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from seriesmill.functions.scalar import is_finite
from seriesmill.operators.asof import keep_last
from seriesmill.plans.blocks import POS, TOTAL, Layout, to_blocks

# Slow-moving columns kept out of the sequence input.
CONTEXT_COLUMNS = ("cycle_months_since_halving", "btc_dominance_pct", "eth_dominance_pct",
                   "total_market_cap_usd", "total_volume_usd_24h")
CONTEXT_PREFIX = "macro_"


def tail(bars: DataFrame, layout: Layout, n: int) -> DataFrame:
    """The last ``n`` bars of every series."""
    placed = to_blocks(bars, Layout(**{**layout.__dict__, "before": 0, "after": 0}))
    return placed.where(F.col(POS) >= F.col(TOTAL) - n).select(*bars.columns)


def latest(df: DataFrame, keys: Sequence[str], ts: str = "ts") -> DataFrame:
    """The newest row per series, by partial aggregation."""
    return keep_last(df, list(keys), [ts]).select(*df.columns)


def labelled(df: DataFrame, direction: str = "direction") -> DataFrame:
    return df.where(F.col(direction).isin(0, 1, 2))


def binary_target(df: DataFrame, direction: str = "direction") -> DataFrame:
    """Up against down."""
    return df.where(F.col(direction).isin(0, 2)).withColumn("y", F.when(F.col(direction) == 2, 1).otherwise(0))


def split_columns(columns: Sequence[str]) -> tuple[list[str], list[str]]:
    """(sequence, context) feature columns."""
    context = [c for c in columns if c in CONTEXT_COLUMNS or c.startswith(CONTEXT_PREFIX)]
    return [c for c in columns if c not in context], context


def shared_columns(frames: Sequence[DataFrame]) -> list[str]:
    """Columns every frame has, in the order of the first."""
    common = set.intersection(*[set(f.columns) for f in frames])
    return [c for c in frames[0].columns if c in common]


def stack(frames: Sequence[DataFrame], columns: Sequence[str] | None = None) -> DataFrame:
    """All rows under one schema: the given columns, or all, with NULL where a frame lacks one."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out.select(*columns) if columns is not None else out


def select_first(df: DataFrame, columns: Sequence[tuple[str, Column]]) -> DataFrame:
    """Named expressions where a repeated name keeps its first meaning."""
    first: dict[str, Column] = {}
    for name, expression in columns:
        first.setdefault(name, expression)
    return df.select(*[e.alias(n) for n, e in first.items()])


def finite_only(df: DataFrame, column: str) -> DataFrame:
    return df.where(is_finite(F.col(column)))
