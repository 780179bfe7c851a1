"""Labels L1-L7 and the forward-horizon join J6."""

from __future__ import annotations

from pyspark.sql import functions as F

from seriesmill.catalog.base import fragment, hourly_bars, lagged, query, r6, roll, running, sql
from seriesmill.catalog.context import DAY_ANCHORS
from seriesmill.catalog.features import DAILY, HOURLY
from seriesmill.functions.scalar import rnd, to_ms
from seriesmill.keys import BARRIER_PARAMS
from seriesmill.operators import indicators as ind, labels as lab
from seriesmill.sources.ticks import bars, daily_bars

K, N = BARRIER_PARAMS["1h"]
HOUR = {"1h": (K, N)}

fragment("hits", ("atr",), f"""
hits AS MATERIALIZED (
  SELECT a.symbol, a.i, min(f.i - a.i) FILTER (f.high >= a.close + {K} * a.atr OR f.low <= a.close - {K} * a.atr) AS k,
         max(f.i - a.i) AS seen
  FROM atr a JOIN atr f ON f.symbol = a.symbol AND f.i BETWEEN a.i + 1 AND a.i + {N} GROUP BY 1, 2)""")
fragment("tb", ("atr", "hits"), f"""
tb AS MATERIALIZED (
  SELECT a.*, CASE WHEN a.atr > 0 IS NOT TRUE OR h.seen IS NULL THEN -1 WHEN h.k IS NULL THEN 1
                   WHEN f.high >= a.close + {K} * a.atr AND f.low <= a.close - {K} * a.atr THEN -1
                   WHEN f.high >= a.close + {K} * a.atr THEN 2 ELSE 0 END AS direction,
         CASE WHEN a.atr > 0 AND h.seen IS NOT NULL THEN coalesce(h.k, h.seen) END AS off,
         CASE WHEN a.atr > 0 IS NOT TRUE OR h.seen IS NULL THEN NULL
              WHEN h.k IS NULL THEN (e.close - a.close) / ({K} * a.atr)
              WHEN f.high >= a.close + {K} * a.atr AND f.low <= a.close - {K} * a.atr THEN 0
              WHEN f.high >= a.close + {K} * a.atr THEN 1 ELSE -1 END AS rr
  FROM atr a LEFT JOIN hits h USING (symbol, i)
  LEFT JOIN atr f ON f.symbol = a.symbol AND f.i = a.i + h.k
  LEFT JOIN atr e ON e.symbol = a.symbol AND e.i = a.i + h.seen)""")
fragment("tq", ("tb",), f"""
tq AS MATERIALIZED (
  SELECT t.symbol, t.i, CAST(coalesce(t.direction IN (0, 2) AND t.atr > 0 AND goal IS NOT NULL AND (stop IS NULL OR goal < stop)
                        AND 2 - 0.0018 * t.close / t.atr > 0, FALSE) AS INTEGER) AS trade_quality
  FROM tb t LEFT JOIN (
    SELECT a.symbol, a.i,
           min(f.i - a.i) FILTER (CASE WHEN a.direction = 2 THEN f.low <= a.close - a.atr ELSE f.high >= a.close + a.atr END) AS stop,
           min(f.i - a.i) FILTER (CASE WHEN a.direction = 2 THEN f.high >= a.close + 2 * a.atr ELSE f.low <= a.close - 2 * a.atr END) AS goal
    FROM tb a JOIN tb f ON f.symbol = a.symbol AND f.i BETWEEN a.i + 1 AND a.i + {2 * N} WHERE a.direction IN (0, 2)
    GROUP BY 1, 2) h USING (symbol, i))""")
fragment("reg_in", ("atr", "ema_state"), f"""
reg_in AS MATERIALIZED (
  SELECT a.symbol, a.i, a.ts_ms, atr_pct, returns_1, ema_stack_score, {roll('stddev_pop', 'log_returns_1', 20)} AS rv,
         ema_50 / {lagged('ema_50', 10)} - 1 AS slope
  FROM atr a JOIN (SELECT symbol, i, ema_50, ema_stack_score FROM ema_state) e USING (symbol, i))""")
fragment("regime", ("reg_in",), """
regime AS MATERIALIZED (
  SELECT symbol, i, ts_ms, CASE
    WHEN returns_1 < -0.10 AND rv > rv_hi THEN 'capitulation'
    WHEN atr_pct > atr_hi AND abs(ema_stack_score) >= 2 THEN 'breakout'
    WHEN rv > rv_hi AND abs(ema_stack_score) < 2 THEN 'ranging_high_vol'
    WHEN rv <= rv_lo AND abs(ema_stack_score) < 2 THEN 'ranging_low_vol'
    WHEN ema_stack_score <= -2 AND slope < 0 THEN 'trending_down'
    WHEN ema_stack_score >= 2 AND slope > 0 THEN 'trending_up' ELSE 'ranging_low_vol' END AS regime
  FROM reg_in JOIN (SELECT symbol, quantile_cont(rv, 0.33) AS rv_lo, quantile_cont(rv, 0.66) AS rv_hi,
                           quantile_cont(atr_pct, 0.85) AS atr_hi FROM reg_in GROUP BY 1) USING (symbol))""")


def _cycle_sql(source: str, anchors: str) -> str:
    return f"""(
  SELECT symbol, i, ts_ms, CASE
    WHEN dd < -0.5 OR (months > 30 AND NOT above) THEN 'accumulation'
    WHEN dd < -0.4 AND NOT above THEN 'bear'
    WHEN months >= 14 AND months <= 24 AND dd > -0.2 AND above THEN 'distribution'
    WHEN months > 4 AND months < 22 AND dd > -0.3 AND above THEN 'bull' ELSE 'accumulation' END AS cycle
  FROM (SELECT symbol, i, ts_ms, floor((epoch(ts) - epoch(a)) / 86400) / 30.4375 AS months, close / nullif(peak, 0) - 1 AS dd,
               coalesce(close > CASE WHEN n <= 1400 THEN acc * pow(q, i) / ((1 - pow(q, i + 1)) / (1 - q)) ELSE long_mean END, FALSE) AS above
        FROM (SELECT *, {running('max', 'close')} AS peak, {roll('avg', 'close', 1400)} AS long_mean,
                     {running('sum', '(close * pow(q, -i))')} AS acc, (SELECT max(adate) FROM {anchors} WHERE adate <= ts) AS a
              FROM (SELECT *, 1 - 2.0 / (n + 1) AS q FROM {source}))))"""


fragment("anchors", (), "anchors AS (SELECT * FROM (VALUES (TIMESTAMP '2012-11-28'), (TIMESTAMP '2016-07-09'), "
                        "(TIMESTAMP '2020-05-11'), (TIMESTAMP '2024-04-19'), (TIMESTAMP '2028-04-01')) a(adate))")
fragment("cycle_d", ("d", "anchor_days"), f"cycle_d AS MATERIALIZED {_cycle_sql('d', 'anchor_days')}")
fragment("cycle_b", ("b", "anchors"), f"cycle_b AS MATERIALIZED {_cycle_sql('b', 'anchors')}")


def hourly_labels(spark, sf_dir, with_regime=True):
    return lab.label_bars(hourly_bars(spark, sf_dir), HOURLY, HOUR, with_regime=with_regime)


@query("j6_forward_horizon", sql(["b"], f"""
SELECT a.symbol, a.ts_ms, CAST(count(f.i) AS BIGINT) AS bars_ahead, {r6('max(f.high)', 'top')}, {r6('min(f.low)', 'bottom')}
FROM b a LEFT JOIN b f ON f.symbol = a.symbol AND f.i BETWEEN a.i + 1 AND a.i + 24 GROUP BY 1, 2"""))
def j6(spark, sf_dir):
    """What the next 24 bars reach, from frames over the blocks: no bar holds a list of others."""
    def ahead(d, L):
        next_ = L.frame(1, 24)
        return d.withColumns({"n": F.count(F.lit(1)).over(next_), "top": F.max("high").over(next_), "bottom": F.min("low").over(next_)})

    df = ind.on_bars(bars(spark, sf_dir), HOURLY, ahead, after=24)
    return df.select("symbol", to_ms(F.col("ts")).alias("ts_ms"), F.col("n").cast("bigint").alias("bars_ahead"),
                     rnd("top").alias("top"), rnd("bottom").alias("bottom"))


@query("l1_triple_barrier", sql(["tb"], f"""
SELECT symbol, ts_ms, CAST(direction AS BIGINT) AS direction, {r6('off', 'barrier_hit_offset')}, {r6('rr', 'barrier_rr')} FROM tb"""))
def l1(spark, sf_dir):
    df = ind.on_bars(bars(spark, sf_dir), HOURLY, ind.add_true_range, ind.add_atr,
                     lambda d, L: lab.add_direction(d, L, K, N, N), before=ind.ATR_LOOKBACK, after=N)
    return df.select("symbol", to_ms(F.col("ts")).alias("ts_ms"), F.col("direction").cast("bigint").alias("direction"),
                     rnd("barrier_hit_offset").alias("barrier_hit_offset"), rnd("barrier_rr").alias("barrier_rr"))


@query("l2_barrier_parameters", sql(["b", "d"], f"""
SELECT timeframe, symbol, CAST(count(*) AS BIGINT) AS bars, CAST(max(h) AS BIGINT) AS horizon, {r6('max(k)', 'atr_multiple')}
FROM (SELECT '1h' AS timeframe, symbol FROM b UNION ALL SELECT '1d', symbol FROM d)
JOIN (VALUES ('15m', 1.5, 32), ('1h', 1.8, 48), ('4h', 2.0, 42), ('1d', 2.5, 30)) p(timeframe, k, h) USING (timeframe) GROUP BY 1, 2"""))
def l2(spark, sf_dir):
    both = bars(spark, sf_dir).unionByName(daily_bars(spark, sf_dir))
    k, n = lab.barrier_params(F.col("timeframe"))
    return both.groupBy("timeframe", "symbol").agg(
        F.count(F.lit(1)).alias("bars"), F.max(n).cast("bigint").alias("horizon"), rnd(F.max(k)).alias("atr_multiple"))


@query("l3_regime", sql(["regime"], "SELECT symbol, ts_ms, regime FROM regime"))
def l3(spark, sf_dir):
    return lab.regime_labels(bars(spark, sf_dir), HOURLY).select("symbol", to_ms(F.col("ts")).alias("ts_ms"), "regime")


@query("l4_cycle", sql(["cycle_d"], "SELECT symbol, ts_ms, cycle FROM cycle_d"))
def l4(spark, sf_dir):
    df = ind.on_bars(daily_bars(spark, sf_dir), DAILY, lambda d, L: lab.add_cycle(d, L, DAY_ANCHORS),
                     before=lab.LONG_MEAN_BARS)
    return df.select("symbol", to_ms(F.col("ts")).alias("ts_ms"), "cycle")


@query("l5_trade_quality", sql(["b", "tq"], "SELECT b.symbol, b.ts_ms, CAST(trade_quality AS BIGINT) AS trade_quality FROM b JOIN tq USING (symbol, i)"))
def l5(spark, sf_dir):
    df = ind.on_bars(bars(spark, sf_dir), HOURLY, ind.add_true_range, ind.add_atr,
                     lambda d, L: lab.add_direction(d, L, K, N, N), lambda d, L: lab.add_trade_quality(d, L, 2 * N, 2 * N),
                     before=ind.ATR_LOOKBACK, after=2 * N)
    return df.select("symbol", to_ms(F.col("ts")).alias("ts_ms"), F.col("trade_quality").cast("bigint").alias("trade_quality"))


@query("l6_trade_quality_fallback", sql(["tb"], """
SELECT symbol, ts_ms, CAST(coalesce(direction IN (0, 2) AND abs(rr) - 0.0018 > 0, FALSE) AS BIGINT) AS trade_quality FROM tb"""))
def l6(spark, sf_dir):
    df = ind.on_bars(bars(spark, sf_dir), HOURLY, ind.add_true_range, ind.add_atr,
                     lambda d, L: lab.add_direction(d, L, K, N, N), before=ind.ATR_LOOKBACK, after=N)
    return df.select("symbol", to_ms(F.col("ts")).alias("ts_ms"), lab.quality_from_outcome(
        F.col("direction"), F.col("barrier_rr")).cast("bigint").alias("trade_quality"))


_ALL_LABELS = "tb JOIN tq USING (symbol, i) JOIN (SELECT symbol, i, regime FROM regime) r USING (symbol, i) JOIN (SELECT symbol, i, cycle FROM cycle_b) c USING (symbol, i)"
fragment("lbl", ("tb", "tq", "regime", "cycle_b"), f"""
lbl AS MATERIALIZED (SELECT tb.symbol, tb.i, tb.ts_ms, tb.ts, direction, off, rr, regime, cycle, trade_quality FROM {_ALL_LABELS})""")


@query("l7_label_all", sql(["lbl"], f"""
SELECT symbol, ts_ms, CAST(direction AS BIGINT) AS direction, {r6('rr', 'barrier_rr')}, regime, cycle,
       CAST(trade_quality AS BIGINT) AS trade_quality FROM lbl"""))
def l7(spark, sf_dir):
    return hourly_labels(spark, sf_dir).select(
        "symbol", to_ms(F.col("ts")).alias("ts_ms"), F.col("direction").cast("bigint").alias("direction"),
        rnd("barrier_rr").alias("barrier_rr"), "regime", "cycle", F.col("trade_quality").cast("bigint").alias("trade_quality"))


@query("l7_label_summary", sql(["lbl"], """
SELECT symbol, CAST(sum(c) AS BIGINT) AS rows, CAST(sum(up) AS BIGINT) AS dir_up, CAST(sum(dn) AS BIGINT) AS dir_down,
       CAST(sum(sd) AS BIGINT) AS dir_sideways, CAST(sum(am) AS BIGINT) AS dir_ambiguous, CAST(sum(tqg) AS BIGINT) AS tq_good,
       string_agg(regime, ',' ORDER BY rk) FILTER (rk <= 3) AS top_regimes
FROM (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY c DESC, regime) AS rk
      FROM (SELECT symbol, regime, count(*) AS c, count(*) FILTER (direction = 2) AS up, count(*) FILTER (direction = 0) AS dn,
                   count(*) FILTER (direction = 1) AS sd, count(*) FILTER (direction = -1) AS am, sum(trade_quality) AS tqg
            FROM lbl GROUP BY 1, 2)) GROUP BY 1"""))
def l7_summary(spark, sf_dir):
    return lab.label_summary(hourly_labels(spark, sf_dir), ["symbol"])
