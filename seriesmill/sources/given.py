"""Context feeds, predictions and other inputs derived from the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from seriesmill.operators.asof import keep_last
from seriesmill.operators.context import DOMINANCE, MACRO, ONCHAIN_BTC, ONCHAIN_ETH
from seriesmill.plans.materialize import settle
from seriesmill.sources.ticks import events


def _of(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    rows = events(spark, sf_dir).where(F.col("event_type") == kind)
    return keep_last(rows.select("ts", "event_id", "user_id", "value"), ["ts"], ["event_id"])


def derivative_feeds(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Irregular market-wide feeds, one event type each."""
    v, even = F.col("value"), F.col("user_id") % 2 == 0
    return {
        "funding_rate": _of(spark, sf_dir, "error").select("ts", ((v - 50) / 100000).alias("funding_rate")),
        "open_interest_hist": _of(spark, sf_dir, "click").select(
            "ts", (v + 1000).alias("open_interest"), ((v + 1000) * 2).alias("open_interest_usd")),
        "global_long_short_ratio": _of(spark, sf_dir, "view").select(
            "ts", (v / 500).alias("global_long_account_pct"), (1 - v / 500).alias("global_short_account_pct"),
            (v / 50).alias("global_long_short_ratio")),
        "top_trader_position_ratio": _of(spark, sf_dir, "signup").select(
            "ts", (v / 500).alias("top_long_position_pct"), (1 - v / 500).alias("top_short_position_pct"),
            (v / 40).alias("top_long_short_ratio")),
        "taker_long_short_volume": _of(spark, sf_dir, "purchase").select(
            "ts", F.when(even, v).otherwise(0.0).alias("taker_buy_volume"),
            F.when(even, 0.0).otherwise(v).alias("taker_sell_volume"),
            F.when(even, 1.0).otherwise(0.0).alias("taker_buy_sell_ratio")),
    }


def daily_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(ts, value)``: highest order value per day."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderdate", "o_totalprice")
    return (orders.groupBy(F.date_trunc("day", F.col("o_orderdate").cast("timestamp")).alias("ts"))
            .agg(F.max("o_totalprice").alias("value")))


def sparse_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with a missing value on some days: the day still counts as the latest row."""
    return daily_series(spark, sf_dir).withColumn(
        "value", F.when(F.dayofmonth("ts") % 7 != 0, F.col("value")))


def shifted_series(spark: SparkSession, sf_dir: str, days: int, factor: float = 1.0) -> DataFrame:
    base = daily_series(spark, sf_dir)
    return base.select((F.col("ts") + F.make_dt_interval(F.lit(days))).alias("ts"),
                       (F.col("value") * factor).alias("value"))


def fear_greed_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily_series(spark, sf_dir).withColumn("value", (F.floor("value") % 101).cast("double"))


def six_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(ts, value)``: the last event's value of every six hours."""
    step = 6 * 3_600_000
    bucket = F.timestamp_millis(F.floor(F.unix_millis("ts") / F.lit(step)) * F.lit(step))
    return events(spark, sf_dir).groupBy(bucket.alias("bucket")).agg(F.max_by("value", F.struct("ts", "event_id")).alias("value")).select(
        F.col("bucket").alias("ts"), "value")


def context_series(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Every single-value context feed in the time range of the events.

    Feed k comes k hours later and k + 1 times as large; one feed has missing values and one is an index from 0 to 100.
    """
    base, feeds = settle(six_hourly(spark, sf_dir)), {}  # read by every feed
    for k, name in enumerate((*ONCHAIN_BTC, *ONCHAIN_ETH, *MACRO, *DOMINANCE)):
        value = F.col("value") * float(k + 1)
        if name == "eth_supply":
            value = F.when(F.dayofmonth("ts") % 7 != 0, value)
        feeds[name] = base.select((F.col("ts") + F.make_dt_interval(F.lit(0), F.lit(k))).alias("ts"), value.alias("value"))
    feeds["fear_greed"] = base.select("ts", (F.floor("value") % 101).cast("double").alias("value"))
    return feeds


def spot_bars(bars: DataFrame) -> DataFrame:
    """Every third bar, closed at its open: the spot table of the same instruments."""
    return bars.where(F.pmod(F.floor(F.unix_seconds("ts") / 3600), F.lit(3)) == 0).withColumn("close", F.col("open"))


def predictions(spark: SparkSession, sf_dir: str, shift: int = 0) -> DataFrame:
    """Per event: class probabilities, quality and true class from the event id."""
    key = F.col("event_id") + shift
    d, s, u = ((key * m) % 1000 + 1 for m in (7919, 104729, 611953))
    total = (d + s + u).cast("double")
    return events(spark, sf_dir).select(
        "event_id", "ts", F.col("event_type").alias("symbol"),
        (d / total).alias("p_down"), (s / total).alias("p_sideways"), (u / total).alias("p_up"),
        (((key * 31) % 1000) / 1000.0).cast("double").alias("quality"),
        (F.col("event_id") % 3).cast("int").alias("y"))
