"""Signals M3-M8, join J7-J8 and trade outcomes T1-T11."""

from __future__ import annotations

from pyspark.sql import functions as F

from seriesmill.catalog.base import fragment, query, r6, shared, sql, uniform_sql
from seriesmill.catalog.dataset import KEYS, ms
from seriesmill.catalog.features import HOURLY
from seriesmill.functions.scalar import rnd, to_ms
from seriesmill.operators import indicators as ind, outcomes as out, signals as sig
from seriesmill.plans.blocks import Layout
from seriesmill.sources import given
from seriesmill.sources.ticks import bars

fragment("pred", (), """
pred AS MATERIALIZED (
  SELECT event_id, ts, epoch_ms(ts) AS ts_ms, symbol, y, d / t AS p_down, s / t AS p_sideways, u / t AS p_up, quality
  FROM (SELECT *, CAST(d + s + u AS DOUBLE) AS t FROM (
    SELECT event_id, ts, event_type AS symbol, event_id % 3 AS y, (event_id * 7919) % 1000 + 1 AS d,
           (event_id * 104729) % 1000 + 1 AS s, (event_id * 611953) % 1000 + 1 AS u,
           ((event_id * 31) % 1000) / 1000.0::DOUBLE AS quality FROM events)))""")
fragment("predc", ("pred",), """
predc AS MATERIALIZED (
  SELECT *, CASE WHEN p_down >= p_sideways AND p_down >= p_up THEN 0 WHEN p_sideways >= p_up THEN 1 ELSE 2 END AS c,
         greatest(p_down, p_sideways, p_up) AS top FROM pred)""")
_t, _q = "0.58::DOUBLE", "0.6::DOUBLE"
_side = f"CASE WHEN top < {_t} THEN 0 WHEN p_up >= {_t} AND quality >= {_q} THEN 1 WHEN p_down >= {_t} AND quality >= {_q} THEN -1 ELSE 0 END"


@query("m3_model_signal", sql(["predc"], f"""
SELECT event_id, CAST({_side} AS BIGINT) AS side,
       {r6(f"CASE {_side} WHEN 1 THEN p_up WHEN -1 THEN p_down ELSE top END", 'confidence')},
       CASE WHEN top < {_t} THEN 'confidence below no_trade threshold' WHEN {_side} = 1 THEN 'long_bias'
            WHEN {_side} = -1 THEN 'short_bias' ELSE 'quality threshold not met' END AS reason FROM predc"""))
def m3(spark, sf_dir):
    df = given.predictions(spark, sf_dir).withColumn("s", sig.model_signal())
    return df.select("event_id", F.col("s.side").cast("bigint").alias("side"), rnd("s.confidence").alias("confidence"), "s.reason")


@query("m4_hedged_signal", sql(["predc"], f"""
SELECT event_id, CASE WHEN event_id % 50 = 0 THEN 'high_risk' WHEN top < {_t} THEN 'no_trade' WHEN p_sideways = top THEN 'range_wait'
   WHEN p_up >= {_t} AND quality >= {_q} THEN 'long_bias' WHEN p_down >= {_t} AND quality >= {_q} THEN 'short_bias' ELSE 'no_trade' END AS action,
   CASE WHEN event_id % 50 = 0 THEN 'funding/OI governor flagged elevated squeeze risk' WHEN top < {_t} THEN 'confidence below configured threshold'
   WHEN p_sideways = top THEN 'model favours sideways/range' WHEN p_up >= {_t} AND quality >= {_q} THEN 'up probability and trade-quality above thresholds'
   WHEN p_down >= {_t} AND quality >= {_q} THEN 'down probability and trade-quality above thresholds' ELSE 'trade-quality below threshold' END AS reason FROM predc"""))
def m4(spark, sf_dir):
    df = given.predictions(spark, sf_dir)
    return df.select("event_id", sig.hedged_signal(F.col("event_id") % 50 == 0).alias("s")).select("event_id", "s.action", "s.reason")


@query("m5_threshold_class", sql(["predc"], """
SELECT event_id, CAST(CASE WHEN top < 0.45::DOUBLE THEN -1 WHEN c = 2 AND p_up >= 0.55::DOUBLE THEN 2 WHEN c = 0 AND p_down >= 0.5::DOUBLE THEN 0
                           WHEN c = 1 THEN 1 ELSE -1 END AS BIGINT) AS predicted FROM predc"""))
def m5(spark, sf_dir):
    return given.predictions(spark, sf_dir).select(
        "event_id", sig.threshold_class(0.55, 0.5, 0.45).cast("bigint").alias("predicted"))


_grid = ", ".join(f"({i}, {g}::DOUBLE)" for i, g in enumerate(sig.GRID))


def _tuned(floor: float) -> str:
    return sql(["predc"], f"""
, g(k, v) AS (VALUES {_grid}),
grid AS (SELECT a.v AS nt, b.v AS lt, c.v AS st, row_number() OVER (ORDER BY a.k, b.k, c.k) AS o
         FROM g a JOIN g b ON b.k >= a.k JOIN g c ON c.k >= a.k),
cov AS (SELECT o, nt, lt, st, c, y FROM grid JOIN predc ON top >= CASE c WHEN 2 THEN lt WHEN 0 THEN st ELSE nt END),
m AS (SELECT o, nt, lt, st, count(*) AS n, count(DISTINCT c) AS k, {', '.join(
    f"count(*) FILTER (c = {k} AND y = {k}) AS tp{k}, count(*) FILTER (c = {k} AND y <> {k}) AS fp{k}, count(*) FILTER (c <> {k} AND y = {k}) AS fn{k}"
    for k in range(3))} FROM cov GROUP BY 1, 2, 3, 4),
f AS (SELECT *, ({' + '.join(f"coalesce(2.0::DOUBLE * tp{k} / nullif(2 * tp{k} + fp{k} + fn{k}, 0), 0)" for k in range(3))})
             / ({' + '.join(f"(tp{k} + fp{k} + fn{k} > 0)::INT" for k in range(3))}) AS f1,
        coalesce(tp2::DOUBLE / nullif(tp2 + fp2, 0), 0) AS lp, coalesce(tp0::DOUBLE / nullif(tp0 + fp0, 0), 0) AS sp,
        (SELECT count(*) FROM predc) AS total FROM m),
best AS (SELECT lt AS l, st AS s, nt AS t, f1, n * 100.0::DOUBLE / total AS cvg, 0 AS r FROM f
         WHERE n >= greatest(20, total // 20) AND k >= 2 AND least(lp, sp) >= {floor}::DOUBLE ORDER BY round(f1, 12) DESC, o LIMIT 1)
SELECT {r6('l', 'long_threshold')}, {r6('s', 'short_threshold')}, {r6('t', 'no_trade_threshold')}, {r6('f1', 'macro_f1')}, {r6('cvg', 'coverage_pct')}
FROM (SELECT * FROM best UNION ALL SELECT 0.58, 0.58, 0.58, 0, 0, 1) ORDER BY r LIMIT 1""").replace("\n, g(k, v)", ", g(k, v)")


def _tune(floor):
    def run(spark, sf_dir):
        best = sig.tune_thresholds(given.predictions(spark, sf_dir), "y", floor)
        return best.select(*[rnd(c).alias(c) for c in best.columns])
    return run


query("m6_threshold_search", _tuned(0.2))(_tune(0.2))
query("m6_threshold_fallback", _tuned(0.45))(_tune(0.45))


@query("j7_threshold_grid", sql(["predc"], f"""
, g(k, v) AS (VALUES {_grid})
SELECT {r6('v', 'threshold')}, CAST(c AS BIGINT) AS predicted, CAST(count(*) AS BIGINT) AS covered, CAST(count(*) FILTER (c = y) AS BIGINT) AS correct
FROM g JOIN predc ON top >= v GROUP BY 1, 2""").replace("\n, g(k", ", g(k"))
def j7(spark, sf_dir):
    """Coverage per threshold: the grid meets per-step counts, never the rows."""
    steps = F.array(*[F.lit(g) for g in sig.GRID])
    top = F.greatest("p_down", "p_sideways", "p_up")
    counts = given.predictions(spark, sf_dir).groupBy(
        F.size(F.filter(steps, lambda g: g <= top)).alias("level"), sig.top_class().cast("bigint").alias("predicted")).agg(
        F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("y") == sig.top_class(), 1)).alias("hit"))
    reached = counts.withColumn("threshold", F.explode(F.slice(steps, F.lit(1), F.col("level"))))
    return reached.groupBy(rnd("threshold").alias("threshold"), "predicted").agg(
        F.sum("n").alias("covered"), F.sum("hit").alias("correct"))


# --- rule strategies and trades -----------------------------------------------------

STRATEGIES = ("buy_and_hold", "ema_trend", "rsi_macd", "majority_class", "no_trade")


def strategy_bars(spark, sf_dir):
    """Bars with the inputs of the rule strategies and their signals."""
    def build(s, d):
        df = ind.on_bars(bars(s, d), HOURLY, ind.ema((9, 21)), ind.add_rsi, ind.add_macd, ind.add_bollinger,
                         ind.add_true_range, ind.add_atr, before=ind.RSI_LOOKBACK, keep_position=True)
        made = {"buy_and_hold": sig.buy_and_hold(), "ema_trend": sig.ema_trend(), "rsi_macd": sig.rsi_macd(),
                "majority_class": sig.majority_class(), "no_trade": sig.no_trade()}
        return df.withColumns(made).select(*KEYS, "ts", "open", "high", "low", "close", "volume", "atr", "_pos",
                                           "bb_mean_reversion_signal", *made)
    return shared(spark, sf_dir, "strategies", build)


_ema_side = "CASE WHEN ema_9 > ema_21 THEN 1 WHEN ema_9 < ema_21 THEN -1 ELSE 0 END"
_rm_side = "CASE WHEN rsi_14 < 30 AND macd_hist > 0 THEN 1 WHEN rsi_14 > 70 AND macd_hist < 0 THEN -1 ELSE 0 END"


@query("m7_rule_strategies", sql(["fm"], f"""
SELECT symbol, ts_ms, CAST((i = 0)::INT AS BIGINT) AS buy_and_hold, CAST({_ema_side} AS BIGINT) AS ema_trend, CAST({_rm_side} AS BIGINT) AS rsi_macd,
       CAST(0 AS BIGINT) AS majority_class, CAST(0 AS BIGINT) AS no_trade,
       CASE WHEN ema_9 IS NULL OR ema_21 IS NULL THEN 'ema unavailable' WHEN ema_9 > ema_21 THEN 'ema9 > ema21' WHEN ema_9 < ema_21 THEN 'ema9 < ema21' ELSE 'ema flat' END AS reason
FROM fm"""))
def m7(spark, sf_dir):
    df = strategy_bars(spark, sf_dir)
    return df.select("symbol", ms(), *[F.col(f"{s}.side").cast("bigint").alias(s) for s in STRATEGIES],
                     F.col("ema_trend.reason").alias("reason"))


@query("m8_random_strategy", sql(["b"], f"""
SELECT symbol, ts_ms, CAST(CASE WHEN u < 0.33::DOUBLE THEN 1 WHEN u < 0.66::DOUBLE THEN -1 ELSE 0 END AS BIGINT) AS side,
       CASE WHEN u < 0.66::DOUBLE THEN 0.33::DOUBLE ELSE 0.34::DOUBLE END AS confidence,
       CASE WHEN u < 0.33::DOUBLE THEN 'random long' WHEN u < 0.66::DOUBLE THEN 'random short' ELSE 'random flat' END AS reason
FROM (SELECT symbol, ts_ms, {uniform_sql("symbol || '|' || ts_ms")} AS u FROM b)"""))
def m8(spark, sf_dir):
    df = bars(spark, sf_dir).withColumn("s", sig.random_signal("symbol", F.unix_millis("ts")))
    return df.select("symbol", ms(), F.col("s.side").cast("bigint").alias("side"), rnd("s.confidence").alias("confidence"), "s.reason")


_slip = lambda a, p: f"CASE WHEN {p} > 0 AND {a} > 0 THEN greatest(2.0::DOUBLE, least(15.0::DOUBLE, 0.02::DOUBLE * {a} / {p} * 10000)) ELSE 2.0::DOUBLE END"


@query("t1_fee", sql(["b"], f"SELECT symbol, ts_ms, {r6('abs(close * volume) * 4.0::DOUBLE / 10000', 'fee')} FROM b"))
def t1(spark, sf_dir):
    return bars(spark, sf_dir).select("symbol", ms(), rnd(out.fee(F.col("close") * F.col("volume"))).alias("fee"))


@query("t2_slippage", sql(["atr"], f"""
SELECT symbol, ts_ms, {r6('bps', 'bps')}, {r6('close * (1 + bps / 10000)', 'buy_at')}, {r6('close * (1 - bps / 10000)', 'sell_at')}
FROM (SELECT *, {_slip('atr', 'close')} AS bps FROM atr)"""))
def t2(spark, sf_dir):
    df = strategy_bars(spark, sf_dir)
    return df.select("symbol", ms(), rnd(out.slip_bps(F.col("atr"), F.col("close"))).alias("bps"),
                     rnd(out.slip_price(F.col("close"), F.col("atr"), F.lit(1))).alias("buy_at"),
                     rnd(out.slip_price(F.col("close"), F.col("atr"), F.lit(-1))).alias("sell_at"))


def signal_bars(spark, sf_dir):
    """Bars with the Bollinger mean-reversion side."""
    return strategy_bars(spark, sf_dir).withColumn("side", F.col("bb_mean_reversion_signal").cast("int"))


fragment("ent", ("atr", "bb"), f"""
ent AS MATERIALIZED (
  SELECT *, entry - side * 1.5 * atr AS stop, 100.0 / (1.5 * atr) AS size FROM (
    SELECT a.symbol, a.i, a.ts, a.ts_ms, a.high, a.low, a.close, a.atr, side, a.close * (1 + side * ({_slip('a.atr', 'a.close')}) / 10000) AS entry
    FROM atr a JOIN (SELECT symbol, i, CASE WHEN close > upper THEN -1 WHEN close < lower THEN 1 ELSE 0 END AS side FROM bb) s USING (symbol, i)))""")


@query("t3_entry_levels", sql(["ent"], f"""
SELECT symbol, ts_ms, CAST(side AS BIGINT) AS side, {r6('entry', 'entry_price')}, {r6('stop', 'stop_price')}, {r6('entry + side * 1.5 * atr', 'tp1')},
       {r6('entry + side * 3 * atr', 'tp2')}, {r6('entry + side * 4.5 * atr', 'tp3')}, {r6('size', 'size')}, {r6('size * entry * 0.0004', 'entry_fee')}
FROM ent WHERE side <> 0 AND atr > 0"""))
def t3(spark, sf_dir):
    df = out.add_entry(signal_bars(spark, sf_dir).where((F.col("side") != 0) & (F.col("atr") > 0)))
    cols = ["entry_price", "stop_price", "tp1", "tp2", "tp3", "size", "entry_fee"]
    return df.select("symbol", ms(), F.col("side").cast("bigint").alias("side"), *[rnd(c).alias(c) for c in cols])


def ladder_trades(spark, sf_dir):
    df = ind.on_bars(signal_bars(spark, sf_dir).drop("_pos"), HOURLY, lambda x, L: out.add_entry(x),
                     lambda x, L: out.add_ladder(x, L, 48), after=48)
    return df.where(F.col("exit_reason").isNotNull())


# the ladder as a recursion over bars held: the state is (share left, stop, targets passed)
_px = lambda p: f"({p}) * (1 - side * ({_slip('atr', f'({p})')}) / 10000)"
_net = lambda p, sh: f"((({_px(p)}) - entry) * side - abs({_px(p)}) * 0.0004) * ({sh})"
_hit = lambda k: f"CASE WHEN side > 0 THEN f.high >= entry + {k} * 1.5 * atr ELSE f.low <= entry - {k} * 1.5 * atr END"


@query("t4_exit_ladder", sql(["ent"], f"""
, lad AS (
  SELECT symbol, i, ts_ms, side, entry, atr, size, stop AS s0, 0 AS k, 1.0::DOUBLE AS lft, stop, 0 AS done, 0.0::DOUBLE AS pnl, NULL::VARCHAR AS reason,
         (SELECT max(i) FROM ent e2 WHERE e2.symbol = ent.symbol) AS last_i
  FROM ent WHERE side <> 0 AND atr > 0
  UNION ALL
  SELECT symbol, i, ts_ms, side, entry, atr, size, s0, k + 1,
         CASE WHEN stopped OR (expd AND NOT p3) OR p3 THEN 0 ELSE lft - sh1 - sh2 END,
         CASE WHEN stopped THEN stop WHEN p2 THEN entry + side * 1.5 * atr WHEN p1 AND done = 0 THEN entry ELSE stop END,
         CASE WHEN p3 THEN 3 WHEN p2 THEN 2 WHEN p1 THEN 1 ELSE done END,
         pnl + CASE WHEN stopped THEN {_net('stop', 'lft')} ELSE {_net('entry + side * 1.5 * atr', 'sh1')} + {_net('entry + side * 3 * atr', 'sh2')}
             + {_net('entry + side * 4.5 * atr', 'sh3')} + CASE WHEN expd AND NOT p3 THEN {_net('fclose', '(lft - sh1 - sh2)')} ELSE 0 END END,
         CASE WHEN stopped THEN 'stop' WHEN p3 THEN 'tp3' WHEN expd THEN 'vertical_barrier' WHEN i + k + 1 = last_i THEN 'end_of_data' END, last_i
  FROM (SELECT *, CASE WHEN p1 THEN 0.33 ELSE 0 END::DOUBLE AS sh1, CASE WHEN p2 THEN 0.33 ELSE 0 END::DOUBLE AS sh2, CASE WHEN p3 THEN 0.34 ELSE 0 END::DOUBLE AS sh3,
               (k + 1 >= 47 OR i + k + 1 = last_i) AS expd
        FROM (SELECT l.*, fclose, stopped, NOT stopped AND done <= 0 AND h1 AS p1, NOT stopped AND done <= 1 AND h2 AS p2, NOT stopped AND done <= 2 AND h3 AS p3
              FROM (SELECT l.*, f.close AS fclose, CASE WHEN side > 0 THEN f.low <= l.stop ELSE f.high >= l.stop END AS stopped,
                           {_hit(1)} AS h1, {_hit(2)} AS h2, {_hit(3)} AS h3
                    FROM lad l JOIN b f ON f.symbol = l.symbol AND f.i = l.i + l.k + 1 WHERE l.reason IS NULL) l)))
SELECT symbol, ts_ms, CAST(side AS BIGINT) AS side, CAST(k AS BIGINT) AS bars_held,
       CASE WHEN reason = 'vertical_barrier' AND k < 47 THEN 'end_of_data' ELSE reason END AS exit_reason, {r6('pnl * size', 'realized_pnl', 4)}, {r6('pnl / abs(entry - s0)', 'rr_realized', 4)}
FROM lad WHERE reason IS NOT NULL""").replace("\n, lad AS", ", lad AS"))
def t4(spark, sf_dir):
    return ladder_trades(spark, sf_dir).select(
        "symbol", ms(), F.col("side").cast("bigint").alias("side"), F.col("bars_held").cast("bigint").alias("bars_held"),
        "exit_reason", rnd("realized_pnl", 4).alias("realized_pnl"), rnd("rr_realized", 4).alias("rr_realized"))


SIDES = ("model", *STRATEGIES, "random")


def trades(spark, sf_dir):
    """Exit-ladder trades of the model (Bollinger reversion stands for it), all rule strategies and the random one."""
    def build(s, d):
        df = strategy_bars(s, d).drop("_pos").withColumn("random", sig.random_signal("symbol", F.unix_millis("ts")))
        sides = {"model": F.col("bb_mean_reversion_signal")} | {k: F.col(f"{k}.side") for k in SIDES[1:]}
        done = ind.on_bars(df, HOURLY, lambda x, L: out.strategy_trades(x, L, 48, sides), after=48)
        return done.where(F.col("exit_reason").isNotNull()).drop("open", "high", "low", "volume", *SIDES[1:])
    return shared(spark, sf_dir, "trades", build)


_rand_side = f"CASE WHEN {uniform_sql(chr(34) + 'symbol' + chr(34) + " || '|' || ts_ms")} < 0.33::DOUBLE THEN 1 WHEN {uniform_sql(chr(34) + 'symbol' + chr(34) + " || '|' || ts_ms")} < 0.66::DOUBLE THEN -1 ELSE 0 END"
fragment("ents", ("fm",), f"""
ents AS MATERIALIZED (
  SELECT *, entry - side * 1.5 * atr AS stop, 100.0 / (1.5 * atr) AS size FROM (
    SELECT symbol, i, n - 1 AS last_i, ts_ms, close, atr, strategy, side, close * (1 + side * ({_slip('atr', 'close')}) / 10000) AS entry
    FROM fm CROSS JOIN LATERAL (VALUES ('model', CAST(bbs AS INT)), ('buy_and_hold', (i = 0)::INT), ('ema_trend', {_ema_side}),
      ('rsi_macd', {_rm_side}), ('majority_class', 0), ('no_trade', 0), ('random', {_rand_side})) v(strategy, side)
    WHERE side <> 0 AND atr > 0))""")
_cost = lambda p, sh: f"abs({_px(p)}) * 0.0004 * ({sh})"
_drag = lambda p, sh: f"abs({_px(p)} - ({p})) * ({sh})"


def _parts(f):
    """A sum over what a bar closes: the stop, the targets and the rest of an expired trade."""
    return (f"CASE WHEN stopped THEN {f('stop', 'lft')} ELSE {f('entry + side * 1.5 * atr', 'sh1')} + {f('entry + side * 3 * atr', 'sh2')}"
            f" + {f('entry + side * 4.5 * atr', 'sh3')} + CASE WHEN expd AND NOT p3 THEN {f('fclose', '(lft - sh1 - sh2)')} ELSE 0 END END")


fragment("lads", ("ents", "b"), f"""
lads AS (
  SELECT strategy, symbol, i, ts_ms, side, close, entry, atr, size, stop AS s0, 0 AS k, 1.0::DOUBLE AS lft, stop, 0 AS done, 0.0::DOUBLE AS pnl,
         0.0::DOUBLE AS fees, 0.0::DOUBLE AS drag, NULL::VARCHAR AS reason, last_i FROM ents
  UNION ALL
  SELECT strategy, symbol, i, ts_ms, side, close, entry, atr, size, s0, k + 1,
         CASE WHEN stopped OR (expd AND NOT p3) OR p3 THEN 0 ELSE lft - sh1 - sh2 END,
         CASE WHEN stopped THEN stop WHEN p2 THEN entry + side * 1.5 * atr WHEN p1 AND done = 0 THEN entry ELSE stop END,
         CASE WHEN p3 THEN 3 WHEN p2 THEN 2 WHEN p1 THEN 1 ELSE done END, pnl + {_parts(_net)}, fees + {_parts(_cost)}, drag + {_parts(_drag)},
         CASE WHEN stopped THEN 'stop' WHEN p3 THEN 'tp3' WHEN expd THEN 'vertical_barrier' WHEN i + k + 1 = last_i THEN 'end_of_data' END, last_i
  FROM (SELECT *, CASE WHEN p1 THEN 0.33 ELSE 0 END::DOUBLE AS sh1, CASE WHEN p2 THEN 0.33 ELSE 0 END::DOUBLE AS sh2, CASE WHEN p3 THEN 0.34 ELSE 0 END::DOUBLE AS sh3,
               (k + 1 >= 47 OR i + k + 1 = last_i) AS expd
        FROM (SELECT l.*, NOT stopped AND done <= 0 AND h1 AS p1, NOT stopped AND done <= 1 AND h2 AS p2, NOT stopped AND done <= 2 AND h3 AS p3
              FROM (SELECT l.*, f.close AS fclose, CASE WHEN side > 0 THEN f.low <= l.stop ELSE f.high >= l.stop END AS stopped,
                           {_hit(1)} AS h1, {_hit(2)} AS h2, {_hit(3)} AS h3
                    FROM lads l JOIN b f ON f.symbol = l.symbol AND f.i = l.i + l.k + 1 WHERE l.reason IS NULL) l)))""")
fragment("trp", ("lads", "b"), """
trp AS MATERIALIZED (
  SELECT l.strategy, l.symbol, l.i, o.ts, l.ts_ms, l.side, l.pnl * size AS pnl, l.pnl / abs(entry - s0) AS rr, size * entry * 0.0004 + l.fees * size AS fees,
         abs(entry - l.close) * size + l.drag * size AS drag, c.ts AS close_ts, c.ts_ms AS close_ms
  FROM lads l JOIN b c ON c.symbol = l.symbol AND c.i = l.i + l.k JOIN b o ON o.symbol = l.symbol AND o.i = l.i WHERE reason IS NOT NULL)""")
# without a losing trade the factor is infinite, without any gain or loss zero
PROFIT_FACTOR = ("CASE WHEN count(*) FILTER (pnl < 0) > 0 THEN coalesce(sum(pnl) FILTER (pnl > 0), 0) / -sum(pnl) FILTER (pnl < 0) "
                 "WHEN count(*) FILTER (pnl > 0) > 0 THEN 'Infinity'::DOUBLE ELSE 0 END")
_T = ["n_trades", "long_trades", "short_trades"]
_TD = ["win_rate", "avg_r", "median_r", "expectancy_r", "profit_factor", "avg_holding_seconds", "long_win_rate", "short_win_rate",
       "fee_drag_total", "slippage_drag_total", "exposure_pct"]


@query("t5_trade_metrics", sql(["trp"], f"""
SELECT strategy, symbol, CAST(count(*) AS BIGINT) AS n_trades, CAST(count(*) FILTER (side = 1) AS BIGINT) AS long_trades, CAST(count(*) FILTER (side = -1) AS BIGINT) AS short_trades,
       {r6('avg((rr > 0)::INT) * 100', 'win_rate', 4)}, {r6('avg(rr)', 'avg_r', 4)}, {r6('quantile_cont(rr, 0.5)', 'median_r', 4)}, {r6('avg(rr)', 'expectancy_r', 4)},
       {r6(PROFIT_FACTOR, 'profit_factor', 4)},
       {r6('avg(close_ms - ts_ms) / 1000', 'avg_holding_seconds', 4)}, {r6('coalesce(avg((rr > 0)::INT) FILTER (side = 1) * 100, 0)', 'long_win_rate', 4)},
       {r6('coalesce(avg((rr > 0)::INT) FILTER (side = -1) * 100, 0)', 'short_win_rate', 4)}, {r6('sum(fees)', 'fee_drag_total', 4)},
       {r6('sum(drag)', 'slippage_drag_total', 4)}, {r6('sum(close_ms - ts_ms) / 3600000.0 / 1000 * 100', 'exposure_pct', 4)}
FROM trp GROUP BY 1, 2"""))
def t5(spark, sf_dir):
    m = out.trade_metrics(trades(spark, sf_dir), ["strategy", "symbol"], total_bars=1000)
    return m.select("strategy", "symbol", *_T, *[rnd(c, 4).alias(c) for c in _TD])


@query("t6_worst_trades", sql(["trp"], f"""
SELECT strategy, CAST(rk AS BIGINT) AS rank, {r6('pnl', 'realized_pnl')} FROM
  (SELECT *, row_number() OVER (PARTITION BY strategy ORDER BY pnl) AS rk FROM trp) WHERE rk <= 10"""))
def t6(spark, sf_dir):
    w = out.worst_trades(trades(spark, sf_dir), ["strategy"], 10, ids=("symbol", "ts"))
    return w.select("strategy", F.col("rank").cast("bigint").alias("rank"), rnd("realized_pnl").alias("realized_pnl"))


CURVE = Layout(step_ms=3_600_000, keys=("strategy", "symbol"), ts="close_ts", ties=("ts",))
fragment("eq", ("trp",), """
eq AS MATERIALIZED (
  SELECT strategy, symbol, close_ms, ts_ms, rr, pnl, equity, row_number() OVER w AS k, max(equity) OVER w AS peak, equity / lag(equity) OVER w - 1 AS ret
  FROM (SELECT *, 10000 + sum(pnl) OVER (PARTITION BY strategy, symbol ORDER BY close_ms, ts_ms ROWS UNBOUNDED PRECEDING) AS equity FROM trp)
  WINDOW w AS (PARTITION BY strategy, symbol ORDER BY close_ms, ts_ms ROWS UNBOUNDED PRECEDING))""")


def curve(spark, sf_dir):
    return shared(spark, sf_dir, "curve", lambda s, d: out.equity_curve(trades(s, d), CURVE))


def metrics(spark, sf_dir):
    return out.equity_metrics(curve(spark, sf_dir), CURVE)


@query("t7_max_drawdown", sql(["eq"], f"SELECT strategy, symbol, {r6('min((equity - peak) / peak) * 100', 'max_drawdown_pct')} FROM eq GROUP BY 1, 2"))
def t7(spark, sf_dir):
    return metrics(spark, sf_dir).select("strategy", "symbol", rnd("max_drawdown_pct").alias("max_drawdown_pct"))


@query("t8_sharpe_sortino", sql(["eq"], f"""
SELECT strategy, symbol, {r6('CASE WHEN count(ret) < 2 OR stddev_pop(ret) = 0 THEN 0 ELSE avg(ret) / stddev_pop(ret) * sqrt(count(ret)) END', 'sharpe')},
       {r6("CASE WHEN count(ret) < 2 THEN 0 WHEN count(*) FILTER (ret < 0) = 0 THEN CASE WHEN avg(ret) > 0 THEN 'Infinity'::DOUBLE ELSE 0 END ELSE avg(ret) / stddev_pop(ret) FILTER (ret < 0) * sqrt(count(ret)) END", 'sortino')}
FROM eq GROUP BY 1, 2"""))
def t8(spark, sf_dir):
    return metrics(spark, sf_dir).select("strategy", "symbol", rnd("sharpe").alias("sharpe"), rnd("sortino").alias("sortino"))


@query("t9_equity_curve", sql(["eq"], f"SELECT strategy, symbol, close_ms, {r6('equity', 'equity', 4)} FROM eq"))
def t9(spark, sf_dir):
    return curve(spark, sf_dir).select("strategy", "symbol", to_ms(F.col("close_ts")).alias("close_ms"), rnd("equity", 4).alias("equity"))


@query("t10_daily_loss_cap", sql(["trp"], """
SELECT a.strategy, a.symbol, a.ts_ms FROM trp a LEFT JOIN trp e ON e.strategy = a.strategy AND e.symbol = a.symbol
  AND date_trunc('day', e.close_ts) = date_trunc('day', a.ts) AND e.close_ms <= a.ts_ms
GROUP BY 1, 2, 3 HAVING coalesce(sum(greatest(-e.pnl, 0)), 0) < 400"""))
def t10(spark, sf_dir):
    kept = out.daily_loss_cap(trades(spark, sf_dir), ["strategy", "symbol"])
    return kept.select("strategy", "symbol", ms())


@query("t11_strategy_comparison", sql(["eq", "b"], f"""
SELECT symbol, strategy, {r6('ret', 'total_return_pct', 4)}, {r6('best', 'best_baseline_return_pct', 4)},
       CASE WHEN own > best THEN 'model beats best baseline' ELSE 'model does not beat the best baseline' END AS verdict
FROM (SELECT *, max(ret) FILTER (strategy <> 'model') OVER (PARTITION BY symbol) AS best, max(ret) FILTER (strategy = 'model') OVER (PARTITION BY symbol) AS own
      FROM (SELECT g.symbol, g.strategy, coalesce(ret, 0) AS ret
            FROM (SELECT DISTINCT symbol, unnest([{', '.join(f"'{k}'" for k in SIDES)}]) AS strategy FROM b) g
            LEFT JOIN (SELECT symbol, strategy, (arg_max(equity, k) / 10000 - 1) * 100 AS ret FROM eq GROUP BY 1, 2) e ON e.symbol = g.symbol AND e.strategy = g.strategy))"""))
def t11(spark, sf_dir):
    """The model against every baseline; a strategy without trades returns 0."""
    every = bars(spark, sf_dir).select("symbol").distinct().withColumn("strategy", F.explode(F.array(*[F.lit(k) for k in SIDES])))
    known = every.join(metrics(spark, sf_dir).select("symbol", "strategy", "total_return_pct"), ["symbol", "strategy"], "left").fillna(0.0, ["total_return_pct"])
    c = out.compare_strategies(known, ["symbol"])
    return c.select("symbol", "strategy", rnd("total_return_pct", 4).alias("total_return_pct"),
                    rnd("best_baseline_return_pct", 4).alias("best_baseline_return_pct"), "verdict")



@query("j8_predictions_join_bars", sql(["pred", "b"], f"""
SELECT b.symbol, b.ts_ms, {r6('b.close', 'close')}, {r6('p.p_up', 'p_up')}
FROM b JOIN (SELECT symbol, date_trunc('hour', ts) AS h, arg_max(p_up, event_id) AS p_up FROM pred GROUP BY 1, 2) p ON p.symbol = b.symbol AND p.h = b.ts"""))
def j8(spark, sf_dir):
    """Newest prediction of each bar joined on series and time, never by row offset."""
    hour = F.timestamp_millis(F.floor(to_ms(F.col("ts")) / 3_600_000) * 3_600_000)
    newest = given.predictions(spark, sf_dir).groupBy("symbol", hour.alias("ts")).agg(F.max_by("p_up", "event_id").alias("p_up"))
    joined = bars(spark, sf_dir).join(newest, ["symbol", "ts"])
    return joined.select("symbol", ms(), rnd("close").alias("close"), rnd("p_up").alias("p_up"))
