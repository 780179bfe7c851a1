"""Bars from raw ticks, and the given tables read as market data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from seriesmill.keys import TIMEFRAME_MS


def order_key(df: DataFrame, order: tuple[str, ...]) -> Column:
    """One comparable value for an order of columns.

    Two time or integer columns are packed into a decimal: a fixed-width key keeps the
    aggregation hash-based, where a struct would force a sort of all ticks.
    """
    kinds = {f.name: f.dataType.typeName() for f in df.schema.fields}
    high_kinds = {"timestamp", "integer", "short", "byte"}  # a plain long would not fit in front
    if len(order) == 1:
        return F.col(order[0])
    if len(order) == 2 and kinds[order[0]] in high_kinds and kinds[order[1]] in high_kinds | {"long"}:
        high, low = (F.unix_micros(c) if kinds[c] == "timestamp" else F.col(c) for c in order)
        shifted = low.cast("decimal(20,0)") + F.lit(str(2 ** 63)).cast("decimal(20,0)")
        # the low part spans 2^64, which the factor exceeds; microseconds have 18 digits
        return high.cast("decimal(18,0)") * F.lit(str(2 * 10 ** 19)).cast("decimal(20,0)") + shifted
    return F.struct(*[F.col(c) for c in order])


def bars_from_ticks(ticks: DataFrame, timeframe: str, *, symbol: str = "symbol", ts: str = "ts",
                    price: str = "price", size: Column | None = None,
                    order: tuple[str, ...] = ("ts",)) -> DataFrame:
    """OHLCV bars per symbol and time bucket; open/close follow ``order`` within the bar.

    A plain aggregation: every mapper reduces a hot symbol to one row per bar first.
    """
    step = TIMEFRAME_MS[timeframe]
    start = F.timestamp_millis(F.floor(F.unix_millis(F.col(ts)) / F.lit(step)) * F.lit(step))
    first = order_key(ticks, order)
    # as values, not constants: the planner drops constant keys from some partitionings
    # and not from others, and would shuffle again to reconcile them
    value = lambda text: F.when(F.col("volume").isNotNull(), text)
    return (
        ticks.groupBy(F.col(symbol).alias("symbol"), start.alias("ts"))
        .agg(F.min_by(price, first).alias("open"), F.max(price).alias("high"),
             F.min(price).alias("low"), F.max_by(price, first).alias("close"),
             F.sum(size if size is not None else F.lit(1.0)).cast("double").alias("volume"))
        .select(value("given").alias("source"), value("spot").alias("market_type"), "symbol",
                value(timeframe).alias("timeframe"), "ts", "open", "high", "low", "close", "volume")
    )


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))


def bars(spark: SparkSession, sf_dir: str, timeframe: str = "1h") -> DataFrame:
    """``events`` as ticks: one symbol per event type, ``value`` as price."""
    ticks = events(spark, sf_dir).select("event_id", "ts", "event_type", "value")
    return bars_from_ticks(ticks, timeframe, symbol="event_type", price="value", order=("ts", "event_id"))


def daily_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``lineitem`` as daily bars: one symbol per return flag, unit price as price."""
    ticks = _table(spark, sf_dir, "lineitem").select(
        F.col("l_shipdate").cast("timestamp").alias("ts"), "l_returnflag", "l_quantity",
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("price"))
    return bars_from_ticks(
        ticks, "1d", symbol="l_returnflag", size=F.col("l_quantity"),
        order=("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "price"))
