"""Bookkeeping tables about stored series: marks, gaps, coverage, periods, validation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from seriesmill.functions.scalar import timeframe_ms, to_ms
from seriesmill.keys import SERIES_KEYS
from seriesmill.plans.blocks import OWN, POS, Layout, lag, to_blocks

# Columns a stored bar table must have.
REQUIRED = ("open_time", "open", "high", "low", "close", "volume")


def watermarks(bars: DataFrame, keys: Sequence[str] = SERIES_KEYS, ts: str = "ts") -> DataFrame:
    """First and last bar and the row count per series."""
    return bars.groupBy(*keys).agg(F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts"), F.count(F.lit(1)).alias("rows"))


def missing_estimate(first: Column, last: Column, rows: Column, timeframe: Column) -> Column:
    """Bars the span should hold minus those it does."""
    expected = F.floor((to_ms(last) - to_ms(first)) / timeframe_ms(timeframe)) + 1
    return F.when(rows < 2, F.lit(0)).otherwise(expected - rows).cast("bigint")


def gaps(bars: DataFrame, layout: Layout) -> DataFrame:
    """Explicit gaps: the bar after each, the one before, and the bars missing between."""
    L = layout.reach(before=1)
    df = to_blocks(bars, L).withColumn("gap_start", lag(L, L.ts)).where(F.col(OWN) & (F.col(POS) > 0))
    apart = F.floor((to_ms(F.col(L.ts)) - to_ms(F.col("gap_start"))) / F.lit(layout.step_ms)) - 1
    return df.withColumn("missing", apart).where("missing > 0").select(*L.keys, "gap_start", F.col(L.ts).alias("gap_end"), "missing")


def coverage(files: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per source: rows, files and checksum outcomes of ``(keys, rows, status, error)``."""
    n = lambda s: F.count(F.when(F.col("status") == s, 1))
    return files.groupBy(*keys).agg(
        F.sum("rows").alias("rows"), F.count(F.lit(1)).alias("files"), n("verified").alias("checksum_verified"),
        n("absent").alias("checksum_absent"), n("mismatch").alias("checksum_mismatch"),
        F.count("error").alias("errors"))


def coverage_scores(metrics: DataFrame, asset: str = "asset", available: str = "available") -> DataFrame:
    """Share of an asset's metrics that are available."""
    return metrics.groupBy(asset).agg(F.avg(F.col(available).cast("double")).alias("score"))


def month_calendar(keys: DataFrame, start: Column, end: Column) -> DataFrame:
    """Every month from ``start`` to ``end`` (dates) per row of ``keys``."""
    months = F.sequence(F.trunc(start, "month"), F.trunc(end, "month"), F.expr("interval 1 month"))
    return keys.withColumn("period", F.explode(months))


def day_calendar(keys: DataFrame, start: Column, end: Column) -> DataFrame:
    return keys.withColumn("period", F.explode(F.sequence(start, end, F.expr("interval 1 day"))))


def missing_periods(calendar: DataFrame, present: DataFrame, on: Sequence[str]) -> DataFrame:
    return calendar.join(present.select(*on).distinct(), list(on), "left_anti")


def validate(rows: DataFrame, keys: Sequence[str], sequence: str = "row_number", required: Sequence[str] = REQUIRED,
             layout: Layout | None = None) -> DataFrame:
    """Counts of problems per stored series; ``sequence`` is the row order in the file.

    Monotony compares neighbours in file order, so rows are blocked by that order.
    """
    missing = [c for c in required if c not in rows.columns]
    if missing:
        return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"), F.lit(f"missing columns {missing}").alias("issues"))
    L = (layout or Layout(step_ms=1)).reach(before=1)
    L = Layout(**{**L.__dict__, "keys": tuple(keys), "ts": "_order"})
    placed = to_blocks(rows.withColumn("_order", F.timestamp_millis(F.col(sequence).cast("bigint"))), L)
    # cast also covers text columns: what does not parse is counted
    t = F.col("open_time").try_cast("bigint")
    placed = placed.withColumns({"_t": t, "_before": lag(L, t)}).where(F.col(OWN))
    n = lambda cond: F.count(F.when(cond, 1))
    counts = placed.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("rows"), n(F.col("_t").isNull()).alias("unparseable"),
        n(F.col("_t") < F.col("_before")).alias("out_of_order"), n(F.col("high") < F.col("low")).alias("high_below_low"),
        n(F.col("volume") < 0).alias("negative_volume"))
    repeats = rows.groupBy(*keys, "open_time").agg(F.count(F.lit(1)).alias("_c")).groupBy(*keys).agg(
        F.sum(F.col("_c") - 1).alias("duplicates"))
    return counts.join(repeats, list(keys))
