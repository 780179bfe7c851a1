"""Streaming and alerting G1-G6."""

from __future__ import annotations

from pyspark.sql import functions as F

from seriesmill.catalog.base import fragment, query, r6, sql
from seriesmill.catalog.dataset import KEYS, ms
from seriesmill.functions.scalar import rnd, to_ms
from seriesmill.operators import monitor, signals as sig
from seriesmill.plans.blocks import Layout
from seriesmill.sources import given, storage
from seriesmill.sources.ticks import bars, daily_bars, events
from seriesmill.streaming import alerts as al, ingest

_b_sql = sql(["b"], f"SELECT symbol, ts_ms, {r6('close', 'close')} FROM b")
_bars_out = lambda df: df.select("symbol", ms(), rnd("close").alias("close"))


def delivered(spark, sf_dir):
    """Bars landed as files, every third bar delivered a second time."""
    path = storage.scratch(spark, "landed")
    b = bars(spark, sf_dir)
    b.write.parquet(path)
    again = b.where(F.pmod(F.floor(F.unix_seconds("ts") / 3600), F.lit(3)) == 0)
    again.write.mode("append").parquet(path)
    return path, b.schema


def _ingested(spark, path, schema, files=1):
    """The table after all landed files went through the ingest stream."""
    table = storage.scratch(spark, "table")
    ingest.ingest_bars(ingest.bar_stream(spark, path, schema, files), table, storage.scratch(spark, "marks")).awaitTermination()
    return table


@query("g1_incremental_ingest", _b_sql)
def g1(spark, sf_dir):
    path, schema = delivered(spark, sf_dir)
    return _bars_out(storage.read_bars(spark, _ingested(spark, path, schema, 2), ["close"]))


@query("g1_late_backfill", sql(["d"], f"SELECT symbol, ts_ms, {r6('close', 'close', 8)} FROM d"))
def g1_backfill(spark, sf_dir):
    """Years of daily bars, newest year first and one file per micro-batch, each year's last file again at the end."""
    path = storage.scratch(spark, "years")
    b = storage.staged(daily_bars(spark, sf_dir), "daily")
    years = sorted((r[0] for r in b.select(F.year("ts")).distinct().collect()), reverse=True)
    for year in [*years, years[0]]:
        b.where(F.year("ts") == year).coalesce(1).write.mode("append").parquet(path)
    df = storage.read_bars(spark, _ingested(spark, path, b.schema), ["close"])
    return df.select("symbol", ms(), rnd("close", 8).alias("close"))


@query("g1_upsert_stream", _b_sql)
def g1_upsert(spark, sf_dir):
    """Wrong closes first, then the right ones as corrections."""
    path, schema = delivered(spark, sf_dir)
    table = storage.scratch(spark, "table")
    storage.merge_bars(spark.read.schema(schema).parquet(path).withColumn("close", -F.col("close")), table)
    ingest.ingest_bars(ingest.bar_stream(spark, path, schema, 2), table, storage.scratch(spark, "marks")).awaitTermination()
    return _bars_out(storage.read_bars(spark, table, ["close"]))


@query("g2_stream_watermarks", sql(["b"], "SELECT symbol, min(ts_ms) AS first_ms, max(ts_ms) AS last_ms, CAST(count(*) AS BIGINT) AS rows FROM b GROUP BY 1"))
def g2(spark, sf_dir):
    path, schema = delivered(spark, sf_dir)
    once = storage.scratch(spark, "distinct")
    storage.read_bars(spark, _ingested(spark, path, schema, 2)).write.parquet(once)
    w = ingest.drain(ingest.stream_watermarks(ingest.bar_stream(spark, once, schema)), spark, "complete")
    return w.select("symbol", to_ms(F.col("first_ts")).alias("first_ms"), to_ms(F.col("last_ts")).alias("last_ms"), "rows")


fragment("al", ("predc",), """
al AS MATERIALIZED (SELECT *, CASE WHEN top < 0.58::DOUBLE THEN 'no_trade' WHEN p_up >= 0.58::DOUBLE AND quality >= 0.6::DOUBLE THEN 'long_bias'
   WHEN p_down >= 0.58::DOUBLE AND quality >= 0.6::DOUBLE THEN 'short_bias' ELSE 'no_trade' END AS signal FROM predc)""")


def _predicted(spark, sf_dir):
    df = given.predictions(spark, sf_dir)
    return df.withColumn("signal", monitor.action(sig.model_signal()["side"])).select(
        "event_id", "ts", F.lit("m1").alias("model_id"), F.col("symbol").alias("asset"), F.lit("1h").alias("timeframe"), "signal",
        "p_down", "p_sideways", "p_up", "quality", F.lit(None).cast("string").alias("regime"), F.lit("bull").alias("cycle"))


_levels = ("entry_reference", "stop_reference", "tp1_reference", "tp2_reference", "tp3_reference")


@query("g3_alert_payload", sql(["al"], f"""
SELECT event_id, 'model_signal' AS alert_type, strftime(ts, '%Y-%m-%dT%H:%M:%S') || '+00:00' AS timestamp_utc, 'm1' AS model_id, symbol AS asset, '1h' AS timeframe,
       signal, {r6('top', 'direction_confidence', 4)}, {r6('quality', 'trade_quality_probability', 4)}, 'unknown' AS regime, 'bull' AS cycle_phase,
       quality * 100 AS entry_reference, {', '.join(f'0.0::DOUBLE AS {c}' for c in _levels[1:])}, 2.0::DOUBLE AS estimated_rr, 1.0::DOUBLE AS risk_per_trade_pct,
       1 AS leverage, CASE WHEN event_id % 2 = 0 THEN event_id % 7 / 2.0::DOUBLE END AS liquidation_buffer_pct, 'up' AS trend,
       {', '.join(f"'unavailable' AS {c}" for c in ('ema_stack', 'rsi', 'macd', 'funding', 'open_interest', 'fear_greed', 'data_coverage_score'))},
       'Decision-support only. Not financial advice.|Validate manually before trading.' AS warnings, 60 AS cooldown_minutes FROM al"""))
def g3(spark, sf_dir):
    """Every field of the payload."""
    card = F.create_map(F.lit("trend_direction"), F.lit("up"))
    refs = {"entry_reference": F.col("quality") * 100,
            "liquidation_buffer_pct": F.when(F.col("event_id") % 2 == 0, (F.col("event_id") % 7) / 2.0)}
    df = _predicted(spark, sf_dir).select("event_id", al.alert_payload(card, refs).alias("p"))
    return df.select("event_id", "p.*").select("*", "scorecard.*").withColumn("warnings", F.array_join("warnings", "|")).drop("scorecard")


@query("g4_alert_gates", sql(["al"], """
SELECT event_id, CASE WHEN signal NOT IN ('long_bias', 'short_bias') THEN 'signal ''' || signal || ''' is non-alerting' WHEN event_id % 11 = 0 THEN 'model is stale'
  WHEN event_id % 13 = 0 THEN 'data coverage below acceptable threshold' WHEN c4 < 0.65::DOUBLE THEN 'direction confidence ' || regexp_replace(regexp_replace(printf('%.4f', c4), '0+$', ''), '[.]$', '.0') || ' < 0.65'
  WHEN q4 < 0.6::DOUBLE THEN 'trade quality ' || regexp_replace(regexp_replace(printf('%.4f', q4), '0+$', ''), '[.]$', '.0') || ' < 0.6' WHEN event_id % 90 < 60 THEN 'cooldown active (' || printf('%.0f', (event_id % 90)::DOUBLE) || ' < 60 min)'
  ELSE 'all gates passed' END AS reason FROM (SELECT *, ROUND(top, 4) AS c4, ROUND(quality, 4) AS q4 FROM al)"""))
def g4(spark, sf_dir):
    k = F.col("event_id")
    df = _predicted(spark, sf_dir).withColumn("p", al.alert_payload())
    reason = al.gate_reason(F.col("p.signal"), F.col("p.direction_confidence"), F.col("p.trade_quality_probability"),
                            stale=k % 11 == 0, coverage_ok=k % 13 != 0, minutes_since_last=(k % 90).cast("double"))
    return df.select("event_id", reason.alias("reason"))


def _alerts(spark, sf_dir):
    return _predicted(spark, sf_dir).where(F.col("signal") != "no_trade").select("asset", F.timestamp_millis(to_ms(F.col("ts"))).alias("ts")).distinct()


# the chain of kept alerts: from each kept one to the first at least an hour later
_chain = sql(["al"], """
, a AS MATERIALIZED (SELECT DISTINCT symbol AS asset, epoch_us(ts) // 1000 AS t FROM al WHERE signal <> 'no_trade'),
nx AS MATERIALIZED (SELECT asset, t, (SELECT min(z.t) FROM a z WHERE z.asset = a.asset AND z.t >= a.t + 3600000) AS nt FROM a),
k AS (SELECT asset, min(t) AS t FROM a GROUP BY 1 UNION ALL SELECT k.asset, nx.nt FROM k JOIN nx ON nx.asset = k.asset AND nx.t = k.t WHERE nx.nt IS NOT NULL)
SELECT asset, t AS ts_ms FROM k""").replace("\n, a AS", ", a AS")


@query("g5_cooldown", _chain)
def g5(spark, sf_dir):
    kept = al.kept_alerts(_alerts(spark, sf_dir), Layout(step_ms=60_000, keys=("asset",)))
    return kept.select("asset", to_ms(F.col("ts")).alias("ts_ms"))


@query("g5_cooldown_stream", _chain)
def g5_stream(spark, sf_dir):
    path = storage.scratch(spark, "alerts")
    a = storage.staged(_alerts(spark, sf_dir), "all-alerts")
    first, last = a.agg(F.min(F.unix_micros("ts")), F.max(F.unix_micros("ts"))).first()
    for k in range(4):  # four deliveries, each a micro-batch of its own: the state is carried on
        quarter = F.floor((F.unix_micros("ts") - F.lit(first)) * 4 / F.lit(max(1, last - first + 1)))
        a.where(quarter == k).coalesce(1).write.mode("append").parquet(path)
    stream = spark.readStream.schema(a.schema).option("maxFilesPerTrigger", 1).parquet(path)
    kept = ingest.drain(al.stream_kept_alerts(stream, ["asset"]), spark)
    return kept.select("asset", to_ms(F.col("ts")).alias("ts_ms"))


@query("g6_bars_from_ticks", sql(["b5"], f"SELECT symbol, ts_ms, {', '.join(r6(c, c) for c in ('open', 'high', 'low', 'close', 'volume'))} FROM b5"))
def g6(spark, sf_dir):
    return bars(spark, sf_dir, "5m").select("symbol", ms(), *[rnd(c).alias(c) for c in ("open", "high", "low", "close", "volume")])


@query("g6_bars_from_tick_stream", sql(["b"], f"SELECT symbol, ts_ms, {', '.join(r6(c, c) for c in ('open', 'high', 'low', 'close', 'volume'))} FROM b"))
def g6_stream(spark, sf_dir):
    """Windows the watermark has closed, and the open ones from a closing pass; a window in both is the same."""
    path = storage.scratch(spark, "ticks")
    e = events(spark, sf_dir).select("event_id", "ts", F.col("event_type").alias("symbol"), F.col("value").alias("price"))
    e.write.parquet(path)
    ticks = spark.readStream.schema(e.schema).parquet(path)
    closed = ingest.drain(ingest.stream_bars(ticks, "1 hour", order=("ts", "event_id")), spark)
    rest = ingest.open_bars(spark.read.schema(e.schema).parquet(path), 3_600_000, order=("ts", "event_id"))
    out = storage.upserted(closed, rest, ["symbol", "ts"])
    return out.select("symbol", ms(), *[rnd(c).alias(c) for c in ("open", "high", "low", "close", "volume")])
