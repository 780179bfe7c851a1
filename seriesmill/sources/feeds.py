"""Context feeds from landed JSON: events, metric lists, nested arrays, snapshots, daily closes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from seriesmill.operators.asof import keep_last

# Source field to canonical column per metric feed.
METRIC_FIELDS = {
    "open_interest_hist": {"sumOpenInterest": "open_interest", "sumOpenInterestValue": "open_interest_usd"},
    "global_long_short_ratio": {"longAccount": "global_long_account_pct", "shortAccount": "global_short_account_pct",
                                "longShortRatio": "global_long_short_ratio"},
    "top_trader_position_ratio": {"longAccount": "top_long_position_pct", "shortAccount": "top_short_position_pct",
                                  "longShortRatio": "top_long_short_ratio"},
    "taker_long_short_volume": {"buyVol": "taker_buy_volume", "sellVol": "taker_sell_volume",
                                "buySellRatio": "taker_buy_sell_ratio"},
}


def number(x: Column) -> Column:
    """Text to double; what does not parse is missing."""
    return x.try_cast("double")


def canonical(df: DataFrame, keys: Sequence[str] = (), ts: str = "ts", order: Sequence[str] = ()) -> DataFrame:
    """UTC timestamps and one row per (keys, ts), the last in ``order``; a missing key fails."""
    if ts not in df.columns:
        raise ValueError(f"no '{ts}' column in {df.columns}")
    out = df.withColumn(ts, F.col(ts).cast("timestamp"))
    return keep_last(out, [*keys, ts], list(order) or [c for c in out.columns if c not in (*keys, ts)])


def _objects(lines: DataFrame, schema: str, column: str = "value") -> DataFrame:
    """Objects of JSON arrays, one row each."""
    return lines.select(F.explode(F.from_json(column, f"array<{schema}>")).alias("o")).select("o.*")


def funding_events(lines: DataFrame) -> DataFrame:
    rows = _objects(lines, "struct<fundingTime:bigint,fundingRate:string,markPrice:string>")
    return rows.select(F.timestamp_millis("fundingTime").alias("ts"), number(F.col("fundingRate")).alias("funding_rate"),
                       number(F.col("markPrice")).alias("mark_price"))


def metric_feed(lines: DataFrame, fields: Mapping[str, str]) -> DataFrame:
    schema = "struct<timestamp:bigint," + ",".join(f"{k}:string" for k in fields) + ">"
    rows = _objects(lines, schema)
    return rows.select(F.timestamp_millis("timestamp").alias("ts"), *[number(F.col(k)).alias(v) for k, v in fields.items()])


def chart_series(lines: DataFrame) -> DataFrame:
    """``{"values": [{"x": seconds, "y": value}]}`` to rows."""
    doc = F.from_json("value", "struct<values:array<struct<x:bigint,y:double>>>")
    return lines.select(F.explode(doc["values"]).alias("v")).select(
        F.timestamp_seconds(F.col("v.x")).alias("ts"), F.col("v.y").alias("value"))


def index_series(lines: DataFrame) -> DataFrame:
    """``{"data": [{"timestamp", "value", "value_classification"}]}`` to rows; values must be integers."""
    doc = F.from_json("value", "struct<data:array<struct<timestamp:string,value:string,value_classification:string>>>")
    return lines.select(F.explode(doc["data"]).alias("v")).select(
        F.timestamp_seconds(F.col("v.timestamp").cast("bigint")).alias("ts"),
        F.col("v.value").cast("smallint").alias("fear_greed_value"),
        F.col("v.value_classification").alias("fear_greed_classification"))


def global_snapshots(lines: DataFrame) -> DataFrame:
    """Dominance and market size from nested maps; snapshots without a usable field are left out."""
    doc = F.from_json("value", "struct<data:struct<market_cap_percentage:map<string,double>,"
                               "total_market_cap:map<string,double>,total_volume:map<string,double>>>")["data"]
    get = lambda field, key: F.try_element_at(doc[field], F.lit(key))
    out = lines.select(
        "ts", get("market_cap_percentage", "btc").alias("btc_dominance_pct"), get("market_cap_percentage", "eth").alias("eth_dominance_pct"),
        get("total_market_cap", "usd").alias("total_market_cap_usd"), get("total_volume", "usd").alias("total_volume_usd_24h"))
    return out.where(F.col("btc_dominance_pct").isNotNull() | F.col("total_market_cap_usd").isNotNull())


def supply_snapshots(lines: DataFrame) -> DataFrame:
    """Supply and burnt fees in whole units (1e18 small units); zero or absent is missing."""
    doc = F.from_json("value", "struct<status:string,result:struct<EthSupply:string,BurntFees:string>>")
    unit = lambda f: F.nullif(number(doc["result"][f]), F.lit(0.0)) / 1e18
    return lines.where(doc["status"] == "1").select("ts", unit("EthSupply").alias("eth_supply"), unit("BurntFees").alias("eth_burnt_fees"))


def gas_snapshots(lines: DataFrame) -> DataFrame:
    doc = F.from_json("value", "struct<status:string,result:struct<SafeGasPrice:string,ProposeGasPrice:string,FastGasPrice:string>>")
    get = lambda f: number(doc["result"][f])
    return lines.where(doc["status"] == "1").select(
        "ts", get("SafeGasPrice").alias("gas_safe_gwei"), get("ProposeGasPrice").alias("gas_propose_gwei"), get("FastGasPrice").alias("gas_fast_gwei"))


def daily_closes(df: DataFrame, day: str = "Date", close: str = "Close") -> DataFrame:
    return df.select(F.col(day).cast("timestamp").alias("ts"), F.col(close).cast("double").alias("value")).where("value IS NOT NULL")
