"""Sources, sinks and bookkeeping S1-S24."""

from __future__ import annotations

import io
import zipfile

import pandas as pd
from pyspark.sql import functions as F

from seriesmill.catalog.base import ORACLES, fragment, query, r6, sql
from seriesmill.catalog.dataset import KEYS, ms
from seriesmill.catalog.features import HOURLY
from seriesmill.catalog.trading import ladder_trades
from seriesmill.functions.scalar import from_ms, rnd, timeframe_ms, to_ms
from seriesmill.plans.blocks import Layout
from seriesmill.sources import catalogue as cat, feeds, given, klines, storage
from seriesmill.sources.ticks import bars, daily_bars, events


def kline_rows(spark, sf_dir):
    """Bars as 12-column kline records."""
    b, t = bars(spark, sf_dir), to_ms(F.col("ts"))
    return b.select("symbol", t.alias("open_time"), "open", "high", "low", "close", "volume", (t + 3_599_999).alias("close_time"),
                    (F.col("volume") * 2).alias("quote_asset_volume"), F.col("volume").cast("bigint").alias("number_of_trades"),
                    (F.col("volume") / 2).alias("taker_buy_base_asset_volume"), (F.col("volume") / 4).alias("taker_buy_quote_asset_volume"),
                    F.lit("0").alias("ignore"))


_kline_sql = sql(["b"], f"""
SELECT ts_ms AS open_time, ts_ms + 3599999 AS close_time, {r6('close', 'close')}, CAST(volume AS BIGINT) AS number_of_trades, {r6('volume / 2', 'taker_buy_base_asset_volume')} FROM b""")
_kline_out = lambda df: df.select("open_time", "close_time", rnd("close").alias("close"), "number_of_trades",
                                  rnd("taker_buy_base_asset_volume").alias("taker_buy_base_asset_volume"))


@query("s1_kline_csv_scan", _kline_sql)
def s1(spark, sf_dir):
    """One folder, four kinds of files: no header (ms), full header, short names (µs), other column order."""
    rows = kline_rows(spark, sf_dir).withColumn("kind", F.pmod(F.hash("symbol", "open_time"), F.lit(4))).drop("symbol")
    path = storage.scratch(spark, "klines")
    kind = lambda k: rows.where(F.col("kind") == k).drop("kind")
    kind(0).write.csv(path)
    kind(1).write.mode("append").option("header", True).csv(path)
    micro = kind(2).withColumns({c: F.col(c) * 1000 for c in ("open_time", "close_time")})
    micro.withColumnsRenamed({v: k for k, v in klines.HEADER_ALIASES.items()}).write.mode("append").option("header", True).csv(path)
    other = kind(3)
    other.select("open_time", *sorted(set(other.columns) - {"open_time"})).write.mode("append").option("header", True).csv(path)
    return _kline_out(klines.read_klines(spark, [path]))


@query("s2_timestamp_units", """
SELECT event_id, CASE WHEN t > 100000000000000 THEN t // 1000 ELSE t END AS open_time
FROM (SELECT event_id, CASE WHEN event_id % 2 = 0 THEN epoch_us(ts) ELSE epoch_us(ts) // 1000 END AS t FROM events)""")
def s2(spark, sf_dir):
    t = F.when(F.col("event_id") % 2 == 0, F.unix_micros("ts")).otherwise(F.unix_millis("ts"))
    return events(spark, sf_dir).select("event_id", klines.to_milliseconds(t).alias("open_time"))


def archives(spark, sf_dir):
    """One ZIP per series and day, as ``path, content``; every other series has a header."""
    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        symbol, day = pdf["symbol"].iloc[0], pdf["day"].iloc[0]
        rows = pdf.sort_values("open_time").drop(columns=["symbol", "day"])
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w") as z:
            z.writestr(zipfile.ZipInfo("rows.csv"), rows.to_csv(index=False, header=symbol in ("purchase", "view")))
        return pd.DataFrame({"path": [f"{symbol}-1h-{day}.zip"], "content": [out.getvalue()]})

    days = kline_rows(spark, sf_dir).withColumn("day", F.date_format(F.timestamp_millis("open_time"), "yyyy-MM-dd"))
    return days.groupBy("symbol", "day").applyInPandas(pack, "path string, content binary")  # at most 24 rows each


@query("s3_archive_expansion", _kline_sql)
def s3(spark, sf_dir):
    return _kline_out(klines.expand_archives(archives(spark, sf_dir)))


@query("s4_checksum_audit", sql(["b"], """
SELECT symbol || '-1h-' || strftime(ts, '%Y-%m-%d') || '.zip' AS path, CASE symbol WHEN 'view' THEN 'absent' WHEN 'error' THEN 'mismatch' ELSE 'verified' END AS status
FROM b GROUP BY 1, 2"""))
def s4(spark, sf_dir):
    files = archives(spark, sf_dir)
    good = F.sha2("content", 256)
    body = F.concat(F.when(F.col("path").startswith("error"), F.reverse(good)).otherwise(F.upper(good)), F.lit("  "), F.col("path"))
    manifest = files.where(~F.col("path").startswith("view")).select("path", body.alias("body"))
    return klines.audit_checksums(files, manifest).select("path", "status")


@query("s5_merge_period_files", sql(["b"], f"SELECT symbol, ts_ms, {r6('CASE WHEN i % 3 = 0 THEN close + 1 ELSE close END', 'close')} FROM b"))
def s5(spark, sf_dir):
    """A second delivery replaces every third bar."""
    from seriesmill.plans.blocks import POS
    from seriesmill.operators import indicators as ind
    first = ind.on_bars(bars(spark, sf_dir), HOURLY, keep_position=True)
    second = first.where(F.col(POS) % 3 == 0).withColumn("close", F.col("close") + 1)
    both = first.withColumn("file_seq", F.lit(1)).unionByName(second.withColumn("file_seq", F.lit(2)))
    return klines.merge_periods(both, KEYS, time="ts").select("symbol", ms(), rnd("close").alias("close"))


def stored(spark, sf_dir):
    path = storage.scratch(spark, "bars")
    storage.write_bars(bars(spark, sf_dir).unionByName(daily_bars(spark, sf_dir)), path)
    return path


@query("s6_partitioned_sink", sql(["b", "d"], """
SELECT '1h' AS timeframe, symbol, CAST(count(*) AS BIGINT) AS rows FROM b GROUP BY 1, 2 UNION ALL SELECT '1d', symbol, CAST(count(*) AS BIGINT) FROM d GROUP BY 1, 2"""))
def s6(spark, sf_dir):
    """An increment (the later hours of one timeframe, delivered again) leaves all else as it was."""
    path = stored(spark, sf_dir)
    storage.write_bars(bars(spark, sf_dir).where("day(ts) > 15"), path)
    return storage.read_bars(spark, path).groupBy("timeframe", "symbol").agg(F.count(F.lit(1)).alias("rows"))


@query("s7_partitioned_scan", sql(["b"], f"SELECT symbol, ts_ms, {r6('close', 'close')} FROM b WHERE symbol = 'click'"))
def s7(spark, sf_dir):
    df = storage.read_bars(spark, stored(spark, sf_dir), ["close"], symbol="click", timeframe="1h")
    return df.select("symbol", ms(), rnd("close").alias("close"))


# --- feeds --------------------------------------------------------------------------

def _lines(df, struct):
    """One JSON array per row, as a feed page with a single object."""
    return df.select(F.to_json(F.array(struct)).alias("value"))


@query("s8_funding_events", f"""
SELECT epoch_us(ts) // 1000 AS ts_ms, CASE WHEN event_id % 97 <> 0 THEN {r6('(value - 50) / 100000', None, 9)} END AS funding_rate, {r6('value', 'mark_price')} FROM events WHERE event_type = 'error'""")
def s8(spark, sf_dir):
    e = events(spark, sf_dir).where("event_type = 'error'")
    rate = F.when(F.col("event_id") % 97 == 0, F.lit("n/a")).otherwise(((F.col("value") - 50) / 100000).cast("string"))
    obj = F.struct(to_ms(F.col("ts")).alias("fundingTime"), rate.alias("fundingRate"), F.col("value").cast("string").alias("markPrice"))
    f = feeds.funding_events(_lines(e, obj))
    return f.select(ms(), rnd("funding_rate", 9).alias("funding_rate"), rnd("mark_price").alias("mark_price"))


@query("s9_metric_feeds", f"""
SELECT 'open_interest_hist' AS feed, epoch_us(ts) // 1000 AS ts_ms, {r6('value + 1000', 'first_metric')} FROM events WHERE event_type = 'click'
UNION ALL SELECT 'global_long_short_ratio', epoch_us(ts) // 1000, {r6('value + 1000')} FROM events WHERE event_type = 'view'
UNION ALL SELECT 'top_trader_position_ratio', epoch_us(ts) // 1000, {r6('value + 1000')} FROM events WHERE event_type = 'signup'
UNION ALL SELECT 'taker_long_short_volume', epoch_us(ts) // 1000, {r6('value + 1000')} FROM events WHERE event_type = 'purchase'""")
def s9(spark, sf_dir):
    kinds = {"open_interest_hist": "click", "global_long_short_ratio": "view", "top_trader_position_ratio": "signup",
             "taker_long_short_volume": "purchase"}
    out = None
    for name, kind in kinds.items():
        fields = feeds.METRIC_FIELDS[name]
        e = events(spark, sf_dir).where(F.col("event_type") == kind)
        obj = F.struct(to_ms(F.col("ts")).alias("timestamp"), *[(F.col("value") + 1000 + k).cast("string").alias(f) for k, f in enumerate(fields)])
        parsed = feeds.metric_feed(_lines(e, obj), fields)
        part = parsed.select(F.lit(name).alias("feed"), ms(), rnd(next(iter(fields.values()))).alias("first_metric"))
        out = part if out is None else out.unionByName(part)
    return out


fragment("day1", (), "day1 AS MATERIALIZED (SELECT date_trunc('day', o_orderdate)::TIMESTAMP AS ts, max(o_totalprice) AS v FROM orders GROUP BY 1)")


def _monthly(spark, sf_dir, struct, wrap):
    days = given.daily_series(spark, sf_dir)
    month = F.date_trunc("month", F.col("ts")).alias("m")
    listed = days.groupBy(month).agg(F.collect_list(struct).alias("l"))  # at most 31 days each
    return listed.select(F.to_json(F.struct(F.col("l").alias(wrap))).alias("value"))


@query("s10_chart_series", sql(["day1"], f"SELECT epoch_ms(ts) AS ts_ms, {r6('v', 'value')} FROM day1"))
def s10(spark, sf_dir):
    lines = _monthly(spark, sf_dir, F.struct(F.unix_seconds("ts").alias("x"), F.col("value").alias("y")), "values")
    return feeds.chart_series(lines).select(ms(), rnd("value").alias("value"))


@query("s11_index_series", sql(["day1"], """
SELECT epoch_ms(ts) AS ts_ms, CAST(floor(v)::BIGINT % 101 AS BIGINT) AS fear_greed_value, CASE WHEN floor(v)::BIGINT % 101 < 50 THEN 'Fear' ELSE 'Greed' END AS fear_greed_classification FROM day1"""))
def s11(spark, sf_dir):
    v = F.floor("value") % 101
    obj = F.struct(F.unix_seconds("ts").cast("string").alias("timestamp"), v.cast("string").alias("value"),
                   F.when(v < 50, "Fear").otherwise("Greed").alias("value_classification"))
    f = feeds.index_series(_monthly(spark, sf_dir, obj, "data"))
    return f.select(ms(), F.col("fear_greed_value").cast("bigint").alias("fear_greed_value"), "fear_greed_classification")


@query("s12_global_snapshots", sql(["day1"], f"""
SELECT epoch_ms(ts) AS ts_ms, {r6('CASE WHEN day(ts) % 5 <> 0 THEN v / 10000 END', 'btc_dominance_pct', 8)}, {r6('v / 20000', 'eth_dominance_pct', 8)},
       {r6('CASE WHEN day(ts) % 3 <> 0 THEN v END', 'total_market_cap_usd')}, NULL::DOUBLE AS total_volume_usd_24h
FROM day1 WHERE day(ts) % 5 <> 0 OR day(ts) % 3 <> 0"""))
def s12(spark, sf_dir):
    v, d = F.col("value"), F.dayofmonth("ts")
    doc = F.struct(F.struct(
        F.struct(F.when(d % 5 != 0, v / 10000).alias("btc"), (v / 20000).alias("eth")).alias("market_cap_percentage"),
        F.struct(F.when(d % 3 != 0, v).alias("usd")).alias("total_market_cap")).alias("data"))
    lines = given.daily_series(spark, sf_dir).select("ts", F.to_json(doc).alias("value"))
    s = feeds.global_snapshots(lines)
    return s.select(ms(), rnd("btc_dominance_pct", 8).alias("btc_dominance_pct"), rnd("eth_dominance_pct", 8).alias("eth_dominance_pct"),
                    rnd("total_market_cap_usd").alias("total_market_cap_usd"), rnd("total_volume_usd_24h").alias("total_volume_usd_24h"))


@query("s13_unit_scaled_snapshots", sql(["day1"], f"""
SELECT epoch_ms(ts) AS ts_ms, {r6('v', 'eth_supply', 4)}, {r6('CASE WHEN day(ts) % 4 <> 0 THEN 2.0::DOUBLE END', 'eth_burnt_fees')}, {r6('day(ts)', 'gas_safe_gwei')} FROM day1"""))
def s13(spark, sf_dir):
    d, v = F.dayofmonth("ts"), F.col("value")
    wei = F.struct(F.lit("1").alias("status"), F.struct((v * 1e18).cast("string").alias("EthSupply"), F.when(d % 4 != 0, "2000000000000000000").otherwise("0")
                                                        .alias("BurntFees")).alias("result"))
    gas = F.struct(F.lit("1").alias("status"), F.struct(d.cast("string").alias("SafeGasPrice")).alias("result"))
    days = given.daily_series(spark, sf_dir)
    supply = feeds.supply_snapshots(days.select("ts", F.to_json(wei).alias("value")))
    fuel = feeds.gas_snapshots(days.select("ts", F.to_json(gas).alias("value")))
    return supply.join(fuel, "ts").select(ms(), rnd("eth_supply", 4).alias("eth_supply"), rnd("eth_burnt_fees").alias("eth_burnt_fees"),
                                          rnd("gas_safe_gwei").alias("gas_safe_gwei"))


@query("s14_daily_closes", sql(["day1"], f"SELECT epoch_ms(ts) AS ts_ms, {r6('v', 'value')} FROM day1"))
def s14(spark, sf_dir):
    path = storage.scratch(spark, "closes")
    storage.write_csv(given.daily_series(spark, sf_dir).select(F.date_format("ts", "yyyy-MM-dd").alias("Date"), F.col("value").alias("Close")), path)
    landed = spark.read.option("header", True).schema("Date string, Close double").csv(path)
    return feeds.daily_closes(landed).select(ms(), rnd("value").alias("value"))


@query("s15_canonical_series", f"""
SELECT epoch_ms(h) AS ts_ms, {r6('arg_max(value, event_id)', 'value')} FROM (SELECT date_trunc('hour', ts) AS h, event_id, value FROM events) GROUP BY 1""")
def s15(spark, sf_dir):
    raw = events(spark, sf_dir).select(F.date_trunc("hour", "ts").alias("ts"), "event_id", "value")
    return feeds.canonical(raw, order=["event_id"]).select(ms(), rnd("value").alias("value"))


@query("s16_idempotent_upsert", sql(["b"], f"SELECT symbol, ts_ms, {r6('CASE WHEN i % 2 = 0 THEN close * 2 ELSE close END', 'close')} FROM b"))
def s16(spark, sf_dir):
    """Stored rows, then twice the same delivery that changes every second bar."""
    from seriesmill.operators import indicators as ind
    base = ind.on_bars(bars(spark, sf_dir), HOURLY, keep_position=True)
    path = storage.scratch(spark, "upsert")
    keys = [*KEYS, "ts"]
    storage.upsert(spark, path, base.select(*keys, "close"), keys)
    change = base.where(F.col("_pos") % 2 == 0).select(*keys, (F.col("close") * 2).alias("close"))
    storage.upsert(spark, path, change, keys)
    final = storage.upsert(spark, path, change, keys)
    return spark.read.parquet(final).select("symbol", ms(), rnd("close").alias("close"))


# --- bookkeeping --------------------------------------------------------------------

@query("s17_watermarks", sql(["b"], "SELECT symbol, min(ts_ms) AS first_ms, max(ts_ms) AS last_ms, CAST(count(*) AS BIGINT) AS rows FROM b GROUP BY 1"))
def s17(spark, sf_dir):
    w = cat.watermarks(bars(spark, sf_dir))
    return w.select("symbol", to_ms(F.col("first_ts")).alias("first_ms"), to_ms(F.col("last_ts")).alias("last_ms"), "rows")


@query("s18_missing_bars", sql(["b"], "SELECT symbol, CAST((max(ts_ms) - min(ts_ms)) // 3600000 + 1 - count(*) AS BIGINT) AS missing FROM b GROUP BY 1"))
def s18(spark, sf_dir):
    w = cat.watermarks(bars(spark, sf_dir))
    return w.select("symbol", cat.missing_estimate(F.col("first_ts"), F.col("last_ts"), F.col("rows"), F.col("timeframe")).alias("missing"))


@query("s18_explicit_gaps", sql(["b"], """
SELECT symbol, prev AS gap_start_ms, ts_ms AS gap_end_ms, CAST((ts_ms - prev) // 3600000 - 1 AS BIGINT) AS missing
FROM (SELECT *, lag(ts_ms) OVER (PARTITION BY symbol ORDER BY i) AS prev FROM b) WHERE ts_ms - prev > 3600000"""))
def s18_gaps(spark, sf_dir):
    g = cat.gaps(bars(spark, sf_dir), HOURLY)
    return g.select("symbol", to_ms(F.col("gap_start")).alias("gap_start_ms"), to_ms(F.col("gap_end")).alias("gap_end_ms"), F.col("missing").cast("bigint").alias("missing"))


@query("s19_coverage", sql(["b"], """
SELECT symbol, CAST(sum(n) AS BIGINT) AS rows, CAST(count(*) AS BIGINT) AS files, CAST(count(*) FILTER (symbol NOT IN ('view', 'error')) AS BIGINT) AS checksum_verified,
       CAST(count(*) FILTER (symbol = 'view') AS BIGINT) AS checksum_absent, CAST(count(*) FILTER (symbol = 'error') AS BIGINT) AS checksum_mismatch, CAST(count(*) FILTER (symbol = 'error') AS BIGINT) AS errors
FROM (SELECT symbol, date_trunc('day', ts) AS day, count(*) AS n FROM b GROUP BY 1, 2) GROUP BY 1"""))
def s19(spark, sf_dir):
    status = F.when(F.col("symbol") == "view", "absent").when(F.col("symbol") == "error", "mismatch").otherwise("verified")
    files = bars(spark, sf_dir).groupBy("symbol", F.date_trunc("day", "ts").alias("day")).agg(F.count(F.lit(1)).alias("rows"))
    files = files.withColumns({"status": status, "error": F.when(status == "mismatch", "checksum mismatch")})
    return cat.coverage(files, ["symbol"])


@query("s20_coverage_scores", sql(["b"], f"SELECT symbol AS asset, {r6('avg((n > 0)::INT)', 'score')} FROM (SELECT symbol, h, count(b.ts) AS n FROM (SELECT DISTINCT symbol FROM b) CROSS JOIN range(24) r(h) LEFT JOIN (SELECT symbol, ts, hour(ts) AS h FROM b WHERE volume >= 9) b USING (symbol, h) GROUP BY 1, 2) GROUP BY 1"))
def s20(spark, sf_dir):
    """An hour of the day is a metric; it is available when a busy bar falls into it."""
    b = bars(spark, sf_dir)
    busy = b.groupBy("symbol", F.hour("ts").alias("metric")).agg((F.count(F.when(F.col("volume") >= 9, 1)) > 0).alias("available"))
    every = b.select("symbol").distinct().withColumn("metric", F.explode(F.sequence(F.lit(0), F.lit(23))))
    metrics = every.join(busy, ["symbol", "metric"], "left").select(F.col("symbol").alias("asset"), F.coalesce("available", F.lit(False)).alias("available"))
    return cat.coverage_scores(metrics).select("asset", rnd("score").alias("score"))


@query("s21_missing_periods", sql(["d"], """
SELECT symbol, CAST(epoch_ms(p) AS BIGINT) AS period_ms FROM (SELECT symbol, unnest(generate_series(min(ts), max(ts), INTERVAL 1 DAY)) AS p FROM d GROUP BY 1) c
WHERE NOT EXISTS (SELECT 1 FROM d WHERE d.symbol = c.symbol AND d.ts = c.p)"""))
def s21(spark, sf_dir):
    d = daily_bars(spark, sf_dir).select("symbol", F.col("ts").cast("date").alias("period"))
    spans = d.groupBy("symbol").agg(F.min("period").alias("a"), F.max("period").alias("z"))
    calendar = cat.day_calendar(spans, F.col("a"), F.col("z")).select("symbol", "period")
    gone = cat.missing_periods(calendar, d, ["symbol", "period"])
    return gone.select("symbol", to_ms(F.col("period").cast("timestamp")).alias("period_ms"))


@query("s21_missing_months", sql(["b"], """
SELECT symbol, CAST(epoch_ms(p) AS BIGINT) AS period_ms FROM (SELECT symbol, unnest(generate_series(TIMESTAMP '2023-07-01', date_trunc('month', max(ts)), INTERVAL 1 MONTH)) AS p FROM b GROUP BY 1) c
WHERE NOT EXISTS (SELECT 1 FROM b WHERE b.symbol = c.symbol AND date_trunc('month', b.ts) = c.p)"""))
def s21_months(spark, sf_dir):
    b = bars(spark, sf_dir).select("symbol", F.trunc("ts", "month").alias("period"))
    spans = b.groupBy("symbol").agg(F.max("period").alias("z"))
    calendar = cat.month_calendar(spans, F.lit("2023-07-01").cast("date"), F.col("z")).select("symbol", "period")
    return cat.missing_periods(calendar, b, ["symbol", "period"]).select("symbol", to_ms(F.col("period").cast("timestamp")).alias("period_ms"))


@query("s22_validation_report", """
SELECT symbol, CAST(count(*) AS BIGINT) AS rows, CAST(count(*) FILTER (open_time IS NULL) AS BIGINT) AS unparseable, CAST(count(*) FILTER (open_time < prev) AS BIGINT) AS out_of_order,
       CAST(count(*) FILTER (high < low) AS BIGINT) AS high_below_low, CAST(count(*) FILTER (volume < 0) AS BIGINT) AS negative_volume, CAST(count(*) - count(DISTINCT h) AS BIGINT) AS duplicates
FROM (SELECT *, lag(open_time) OVER (PARTITION BY symbol ORDER BY event_id) AS prev
      FROM (SELECT event_type AS symbol, event_id, epoch_ms(date_trunc('hour', ts)) AS h, epoch_ms(date_trunc('hour', ts)) AS open_time, value AS high, 50 AS low, value - 1 AS volume FROM events)) GROUP BY 1""")
def s22(spark, sf_dir):
    """Raw events read as a faulty bar table in id order."""
    raw = events(spark, sf_dir).select(
        F.col("event_type").alias("symbol"), "event_id", to_ms(F.date_trunc("hour", "ts")).alias("open_time"), F.col("value").alias("open"),
        F.col("value").alias("high"), F.lit(50.0).alias("low"), F.col("value").alias("close"), (F.col("value") - 1).alias("volume"))
    r = cat.validate(raw, ["symbol"], "event_id", layout=Layout(step_ms=1, keys=("symbol",)))
    return r.select("symbol", "rows", "unparseable", "out_of_order", "high_below_low", "negative_volume", "duplicates")


@query("s23_report_sinks", f"""
SELECT sink, exit_reason, CAST(count(*) * max(copies) AS BIGINT) AS trades
FROM ({ORACLES['t4_exit_ladder']}) CROSS JOIN (VALUES ('csv', 1), ('json', 2)) s(sink, copies) GROUP BY 1, 2""")
def s23(spark, sf_dir):
    """Trades as CSV, one struct per trade as JSON, appended to twice; read back and counted."""
    t = ladder_trades(spark, sf_dir).select("symbol", "ts", "side", "entry_price", "exit_price", "size", "stop_price", "tp1", "tp2", "tp3",
                                            "realized_pnl", "rr_realized", "exit_reason", "fees_paid", "slippage_cost")
    csv, json = storage.scratch(spark, "trades-csv"), storage.scratch(spark, "trades-json")
    storage.write_csv(t, csv)
    nested = t.select("symbol", "ts", F.struct("tp1", "tp2", "tp3").alias("targets"), "realized_pnl", "exit_reason")
    storage.write_json(nested, json)
    storage.append_json(nested, json)
    back = spark.read.option("header", True).schema(t.schema).csv(csv).select(F.lit("csv").alias("sink"), "exit_reason")
    logged = spark.read.schema(nested.schema).json(json).select(F.lit("json").alias("sink"), "exit_reason")
    return back.unionByName(logged).groupBy("sink", "exit_reason").agg(F.count(F.lit(1)).alias("trades"))


@query("s24_time_helpers", sql(["b", "d"], """
SELECT '1h' AS timeframe, symbol, ts_ms, ts_ms // 3600000 * 3600000 + 3600000 AS next_bar_ms FROM b
UNION ALL SELECT '1d', symbol, ts_ms, ts_ms // 86400000 * 86400000 + 86400000 FROM d"""))
def s24(spark, sf_dir):
    both = bars(spark, sf_dir).unionByName(daily_bars(spark, sf_dir))
    step = timeframe_ms(F.col("timeframe"))
    following = from_ms(F.floor(to_ms(F.col("ts")) / step) * step + step)
    return both.select("timeframe", "symbol", ms(), to_ms(following).alias("next_bar_ms"))
