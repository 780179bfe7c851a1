"""Window kernels W and feature operators F1-F34 on bars built from the given events."""

from __future__ import annotations

from pyspark.sql import functions as F

from seriesmill.catalog import sqltext  # noqa: F401  (registers the shared CTEs)
from seriesmill.catalog.base import (
    ffill, fl, fragment, lagged, out_columns, query, r6, roll, running, sql,
)
from seriesmill.operators import indicators as ind, patterns as pat, structure as stc
from seriesmill.plans.blocks import (
    Layout, Rolling, Running, Smooth, ema_reach, lag, pct_change, span, with_long_rolling,
    with_running, with_smooth,
)
from seriesmill.sources.ticks import bars, daily_bars

HOURLY = Layout(step_ms=3_600_000)
DAILY = Layout(step_ms=86_400_000)


#: SQL of the matrix columns on hourly bars: column -> (CTEs, table, expression).
MATRIX_SQL: dict[str, tuple[tuple[str, ...], str, str]] = {}


def bar_query(name, columns, steps, deps, exprs, *, before=0, source=bars, layout=HOURLY, table="b"):
    """Register a feature query: bars in, ``symbol, ts_ms, columns`` out."""
    on_hours = ("b",) if source is daily_bars else tuple(deps)
    MATRIX_SQL.update({c: (on_hours, "b" if source is daily_bars else table, exprs[c]) for c in columns})
    select = ", ".join(r6(exprs[c], c) for c in columns)
    text = sql(deps, f"SELECT symbol, ts_ms, {select} FROM {table}")

    @query(name, text)
    def run(spark, sf_dir):
        df = ind.on_bars(source(spark, sf_dir), layout, *steps, before=before)
        return out_columns(df, columns)

    return run


def add(**columns):
    """A step adding columns built from the layout."""
    return lambda df, L: df.withColumns({k: make(L) for k, make in columns.items()})


# --- kernels ------------------------------------------------------------------------

bar_query("w1_lag", ["lag_1", "lag_3"], [add(lag_1=lambda L: lag(L, "close"), lag_3=lambda L: lag(L, "close", 3))],
          ["b"], {"lag_1": lagged("close"), "lag_3": lagged("close", 3)}, before=3)
bar_query("w2_diff", ["diff_1"], [add(diff_1=lambda L: F.col("close") - lag(L, "close"))],
          ["b"], {"diff_1": f"close - {lagged('close')}"}, before=1)
bar_query("w3_pct_change", ["pct_1", "pct_10"],
          [add(pct_1=lambda L: pct_change(L, "close"), pct_10=lambda L: pct_change(L, "close", 10))], ["b"],
          {"pct_1": f"close / nullif({lagged('close')}, 0) - 1",
           "pct_10": f"close / nullif({lagged('close', 10)}, 0) - 1"}, before=10)
bar_query("w4_rolling_mean_sum", ["mean_20", "sum_20"],
          [add(mean_20=lambda L: Rolling(L, 20).mean("close"), sum_20=lambda L: Rolling(L, 20).sum("volume"))],
          ["b"], {"mean_20": roll("avg", "close", 20), "sum_20": roll("sum", "volume", 20)}, before=20)
bar_query("w5_rolling_std", ["std_20"], [add(std_20=lambda L: Rolling(L, 20).std("close"))],
          ["b"], {"std_20": roll("stddev_pop", "close", 20)}, before=20)
bar_query("w6_rolling_zscore", ["z_50"], [add(z_50=lambda L: Rolling(L, 50).zscore("close"))],
          ["b"], {"z_50": f"(close - ({roll('avg', 'close', 50)})) / nullif({roll('stddev_pop', 'close', 50)}, 0)"},
          before=50)
bar_query("w7_rolling_extremes", ["max_20", "min_20", "prior_max_20", "long_max_300", "long_mean_300"],
          [add(max_20=lambda L: Rolling(L, 20).max("high"), min_20=lambda L: Rolling(L, 20).min("low"),
               prior_max_20=lambda L: Rolling(L, 20, shift=1).max("high")),
           lambda df, L: with_long_rolling(df, L, {"long_max_300": ("max", "close", 300),
                                                   "long_mean_300": ("mean", "close", 300)})],
          ["b"], {"max_20": roll("max", "high", 20), "min_20": roll("min", "low", 20),
                  "prior_max_20": roll("max", "high", 20, shift=1), "long_max_300": roll("max", "close", 300),
                  "long_mean_300": roll("avg", "close", 300)}, before=300)
bar_query("w8_cumulative", ["cum_max", "cum_min", "cum_sum"],
          [lambda df, L: with_running(df, L, {"cum_max": Running("max", "close"), "cum_min": Running("min", "close"),
                                              "cum_sum": Running("sum", "volume")})],
          ["b"], {"cum_max": running("max", "close"), "cum_min": running("min", "close"),
                  "cum_sum": running("sum", "volume")})
bar_query("w9_forward_fill", ["filled"],
          [lambda df, L: with_running(df.withColumn("_x", F.when(F.col("volume") > 3, F.col("close"))), L,
                                      {"filled": Running("last", "_x")})],
          ["b"], {"filled": ffill("CASE WHEN volume > 3 THEN close END")})
bar_query("w10_ema_span", ["ema_21"], [ind.ema((21,))], ["ema"], {"ema_21": "ema_21"},
          before=ema_reach(span(21)), table="ema")
bar_query("w11_wilder_average", ["wilder_14"],
          [ind.add_true_range, lambda df, L: with_smooth(df, L, {"wilder_14": Smooth("true_range", 1 / 14, 14)})],
          ["atr"], {"wilder_14": "atr"}, before=ind.ATR_LOOKBACK, table="atr")


def _adjusted(df, L, n=50):
    """Weights normalised by their sum: numerator recursion over a closed-form denominator."""
    gain = span(n)
    df = df.withColumn("_first", F.col("close") / F.lit(gain))
    df = df.withColumn("_x", F.when(F.col("_pos") == 0, F.col("_first")).otherwise(F.col("close") / F.lit(gain)))
    df = with_smooth(df.withColumn("_y", F.when(F.col("_pos") == 0, F.col("close")).otherwise(F.col("_x"))), L,
                     {"_num": Smooth("_y", gain, 1)})
    weight = (1 - F.pow(F.lit(1 - gain), F.col("_pos").cast("double") + 1)) / F.lit(gain)
    return df.withColumn("ema_adjusted_50", F.col("_num") / weight)


fragment("adj_raw", ("b",), """
adj_raw AS (
  SELECT symbol, i, close AS num, CAST(1 AS DOUBLE) AS den FROM b WHERE i = 0
  UNION ALL
  SELECT s.symbol, s.i, p.num * (1 - 2.0 / 51) + s.close, p.den * (1 - 2.0 / 51) + 1
  FROM adj_raw p JOIN b s ON s.symbol = p.symbol AND s.i = p.i + 1)""")
bar_query("w12_ema_adjusted", ["ema_adjusted_50"], [_adjusted], ["b", "adj_raw"],
          {"ema_adjusted_50": "num / den"}, before=ema_reach(span(50)), table="b JOIN adj_raw USING (symbol, i)")
bar_query("w13_cross_detection", ["up", "down"],
          # nine decimals: two means that are equal must stay equal in any order of summation
          [add(a=lambda L: F.round(Rolling(L, 5).mean("close"), 9), c=lambda L: F.round(Rolling(L, 20).mean("close"), 9)),
           add(up=lambda L: ind.cross_up(L, "a", "c"), down=lambda L: ind.cross_down(L, "a", "c"))], ["b"],
          {"up": fl(f"a > c AND {lagged('a')} <= {lagged('c')}"), "down": fl(f"a < c AND {lagged('a')} >= {lagged('c')}")},
          before=25, table=f"(SELECT *, round({roll('avg', 'close', 5)}, 9) AS a, round({roll('avg', 'close', 20)}, 9) AS c FROM b)")
bar_query("w14_previous_event_value", ["current_event", "previous_event"],
          [lambda df, L: with_running(
              df.withColumn("current_event", F.when(F.col("volume") > 3, F.col("close"))), L,
              {"previous_event": Running("last", "current_event", strict=True)})],
          ["b"], {"current_event": "x", "previous_event": ffill("x", strict=True)},
          table="(SELECT *, CASE WHEN volume > 3 THEN close END AS x FROM b)")


@query("w15_row_position", sql(["b"], "SELECT symbol, ts_ms, CAST(i AS BIGINT) AS pos, CAST(n AS BIGINT) AS total FROM b"))
def w15(spark, sf_dir):
    df = ind.on_bars(bars(spark, sf_dir), HOURLY, keep_position=True)
    return df.select("symbol", F.unix_millis("ts").alias("ts_ms"), F.col("_pos").cast("bigint").alias("pos"),
                     F.col("_total").cast("bigint").alias("total"))


@query("w16_sequence_window", sql(["b"], f"""
SELECT symbol, ts_ms, CAST(len(w) AS BIGINT) AS steps, {r6('list_sum(w)', 'total')}, {r6('w[1]', 'oldest')}, {r6('w[8]', 'newest')}
FROM (SELECT symbol, ts_ms, i, list(close) OVER (PARTITION BY symbol ORDER BY i ROWS BETWEEN 7 PRECEDING AND CURRENT ROW) AS w FROM b)
WHERE i >= 7"""))
def w16(spark, sf_dir):
    from seriesmill.operators.dataset import add_sequence
    df = ind.on_bars(bars(spark, sf_dir), HOURLY, lambda d, L: add_sequence(d, L, ["close"], 8), before=8)
    seq = F.transform("x_seq", lambda step: step[0])
    return df.where(F.col("x_seq").isNotNull()).select(
        "symbol", F.unix_millis("ts").alias("ts_ms"), F.size(seq).cast("bigint").alias("steps"),
        (F.round(F.aggregate(seq, F.lit(0.0), lambda a, x: a + x), 6) + 0.0).alias("total"),
        (F.round(seq[0], 6) + 0.0).alias("oldest"), (F.round(seq[7], 6) + 0.0).alias("newest"))


# --- indicators ---------------------------------------------------------------------

bar_query("f1_returns", ["returns_1", "log_returns_1"], [ind.add_returns], ["moves"],
          {"returns_1": "returns_1", "log_returns_1": "log_returns_1"}, before=1, table="moves")
_emas = [f"ema_{n}" for n in ind.EMA_SPANS]
bar_query("f2_ema", _emas, [ind.add_ema], ["ema"], {c: c for c in _emas}, before=ind.EMA_LOOKBACK, table="ema")
_ema_steps = [ind.add_ema, ind.add_ema_state]
bar_query("f3_ema_stack_score", ["ema_stack_score"], _ema_steps, ["ema_state"], {"ema_stack_score": "ema_stack_score"},
          before=ind.EMA_LOOKBACK, table="ema_state")
bar_query("f4_price_vs_ema", ["price_above_ema_200", "price_above_ema_120", "ema_120_cycle_signal"], _ema_steps, ["ema"],
          {"price_above_ema_200": fl("close > ema_200"), "price_above_ema_120": fl("close > ema_120"),
           "ema_120_cycle_signal": "CASE WHEN close > ema_120 THEN 1 ELSE -1 END"},
          before=ind.EMA_LOOKBACK, table="ema")
bar_query("f5_ema_crosses", ["golden_cross", "death_cross"], _ema_steps, ["ema"],
          {"golden_cross": fl(f"ema_50 > ema_200 AND {lagged('ema_50')} <= {lagged('ema_200')}"),
           "death_cross": fl(f"ema_50 < ema_200 AND {lagged('ema_50')} >= {lagged('ema_200')}")},
          before=ind.EMA_LOOKBACK, table="ema")
bar_query("f6_sma", ["sma_50", "sma_200"], [ind.add_sma], ["b"],
          {f"sma_{n}": roll("avg", "close", n) for n in (50, 200)}, before=200)
bar_query("f7_rsi", ["rsi_14"], [ind.add_rsi], ["rsi"], {"rsi_14": "rsi_14"}, before=ind.RSI_LOOKBACK, table="rsi")
bar_query("f8_rsi_state", ["rsi_14_slope", "rsi_14_overbought", "rsi_14_oversold", "rsi_14_zscore_50"],
          [ind.add_rsi, ind.add_rsi_state], ["rsi"],
          {"rsi_14_slope": f"rsi_14 - {lagged('rsi_14')}", "rsi_14_overbought": fl("rsi_14 > 70"),
           "rsi_14_oversold": fl("rsi_14 < 30"),
           "rsi_14_zscore_50": f"(rsi_14 - ({roll('avg', 'rsi_14', 50)})) / nullif({roll('stddev_pop', 'rsi_14', 50)}, 0)"},
          before=ind.RSI_LOOKBACK, table="rsi")
_macd = ["macd_line", "macd_signal", "macd_hist", "macd_hist_slope", "macd_cross_up", "macd_cross_down"]
bar_query("f9_macd", _macd, [ind.add_macd], ["macd"],
          {"macd_line": "macd_line", "macd_signal": "macd_signal", "macd_hist": "macd_hist",
           "macd_hist_slope": f"macd_hist - {lagged('macd_hist')}",
           "macd_cross_up": fl(f"macd_line > macd_signal AND {lagged('macd_line')} <= {lagged('macd_signal')}"),
           "macd_cross_down": fl(f"macd_line < macd_signal AND {lagged('macd_line')} >= {lagged('macd_signal')}")},
          before=ind.MACD_LOOKBACK, table="macd")
fragment("bb", ("b",), f"""
bb AS MATERIALIZED (
  SELECT *, mid + 2 * sd AS upper, mid - 2 * sd AS lower
  FROM (SELECT *, {roll('avg', 'close', 20)} AS mid, {roll('stddev_pop', 'close', 20)} AS sd FROM b))""")
_bb = ["bb_upper", "bb_lower", "bb_mid", "bb_pct_b", "bb_bandwidth", "bb_mean_reversion_signal"]
bar_query("f10_bollinger", _bb, [ind.add_bollinger], ["bb"],
          {"bb_upper": "upper", "bb_lower": "lower", "bb_mid": "mid",
           "bb_pct_b": "(close - lower) / nullif(upper - lower, 0)", "bb_bandwidth": "(upper - lower) / nullif(mid, 0)",
           "bb_mean_reversion_signal": "CASE WHEN close > upper THEN -1 WHEN close < lower THEN 1 ELSE 0 END"},
          before=20, table="bb")
bar_query("f11_true_range", ["true_range"], [ind.add_true_range], ["moves"], {"true_range": "true_range"}, before=1,
          table="moves")
bar_query("f12_atr", ["atr", "atr_pct"], [ind.add_true_range, ind.add_atr], ["atr"], {"atr": "atr", "atr_pct": "atr_pct"},
          before=ind.ATR_LOOKBACK, table="atr")
_z = lambda x, n: f"({x} - ({roll('avg', x, n)})) / nullif({roll('stddev_pop', x, n)}, 0)"
bar_query("f13_volume", ["volume_log", "volume_zscore_20", "volume_zscore_50", "volume_spike"], [ind.add_volume], ["b"],
          {"volume_log": "ln(1 + volume)", "volume_zscore_20": _z("volume", 20), "volume_zscore_50": _z("volume", 50),
           "volume_spike": fl(f"{_z('volume', 20)} > 2.0::DOUBLE + 1e-12")}, before=50)
bar_query("f14_obv", ["obv"], [ind.add_obv], ["moves"],
          {"obv": running("sum", "sign(coalesce(chg, 0)) * volume")}, before=1, table="moves")
bar_query("f15_vwap", ["vwap_24", "vwap_72"], [ind.add_vwap], ["b"],
          {f"vwap_{n}": f"({roll('sum', 'pv', n)}) / nullif({roll('sum', 'volume', n)}, 0)" for n in (24, 72)},
          before=72, table="(SELECT *, (high + low + close) / 3.0 * volume AS pv FROM b)")
_vols = ["realized_volatility_20", "realized_volatility_50", "realized_volatility_100", "realized_volatility"]
bar_query("f16_realized_volatility", _vols, [ind.add_volatility], ["moves"],
          {**{f"realized_volatility_{n}": roll("stddev_pop", "log_returns_1", n) for n in (20, 50, 100)},
           "realized_volatility": roll("stddev_pop", "log_returns_1", 20)}, before=101, table="moves")
bar_query("f17_distance_from_extremes", ["distance_from_ath_pct", "distance_from_atl_pct"], [ind.add_extremes], ["b"],
          {"distance_from_ath_pct": f"close / nullif({running('max', 'close')}, 0) - 1",
           "distance_from_atl_pct": f"close / nullif({running('min', 'close')}, 0) - 1"})
_year = [f"distance_from_{k}_{s}" for k in ind.YEAR_WINDOWS for s in ("high", "low")]
bar_query("f18_distance_from_year_extremes", _year, [ind.add_year_extremes], ["d"],
          {f"distance_from_{k}_{s}": f"close / nullif({roll('max' if s == 'high' else 'min', 'close', n)}, 0) - 1"
           for k, n in ind.YEAR_WINDOWS.items() for s in ("high", "low")},
          before=8760, source=daily_bars, layout=DAILY, table="d")

# --- structure ----------------------------------------------------------------------

fragment("sw", ("b",), f"""
sw AS MATERIALIZED (
  SELECT *, CASE WHEN high > ph THEN high END AS sh, CASE WHEN low < pl THEN low END AS sl,
         CASE WHEN high > ph5 THEN high END AS sh5, CASE WHEN low < pl5 THEN low END AS sl5
  FROM (SELECT *, {roll('max', 'high', 10, shift=1)} AS ph, {roll('min', 'low', 10, shift=1)} AS pl,
               {roll('max', 'high', 5, shift=1)} AS ph5, {roll('min', 'low', 5, shift=1)} AS pl5 FROM b))""")
fragment("swf", ("sw",), f"""
swf AS MATERIALIZED (
  SELECT *, {fl('sh > psh', 'hh')}, {fl('sh < psh', 'lh')}, {fl('sl > psl', 'hl')}, {fl('sl < psl', 'll')}
  FROM (SELECT *, {ffill('sh', strict=True)} AS psh, {ffill('sl', strict=True)} AS psl FROM sw))""")
bar_query("f19_swing_flags", ["swing_high_flag", "swing_low_flag"],
          [add(swing_high_flag=lambda L: stc.swing_high(L, 10), swing_low_flag=lambda L: stc.swing_low(L, 10))], ["sw"],
          {"swing_high_flag": fl("sh IS NOT NULL"), "swing_low_flag": fl("sl IS NOT NULL")}, before=11, table="sw")
bar_query("f20_last_swings", ["last_swing_high", "last_swing_low", "distance_to_last_swing_high", "distance_to_last_swing_low"],
          [stc.add_swings], ["sw"],
          {"last_swing_high": ffill("sh"), "last_swing_low": ffill("sl"),
           "distance_to_last_swing_high": f"close / nullif({ffill('sh')}, 0) - 1",
           "distance_to_last_swing_low": f"close / nullif({ffill('sl')}, 0) - 1"}, before=11, table="sw")
bar_query("f21_swing_sequence_flags", [f"swing_{k}_flag" for k in ("hh", "lh", "hl", "ll")], [stc.add_swings], ["swf"],
          {f"swing_{k}_flag": k for k in ("hh", "lh", "hl", "ll")}, before=11, table="swf")
bar_query("f22_market_structure_score", ["market_structure_score"], [stc.add_swings, stc.add_structure_score], ["swf"],
          {"market_structure_score": "greatest(least(" + " + ".join(running("max", k) for k in ("hh", "hl"))
           + " - " + " - ".join(running("max", k) for k in ("lh", "ll")) + ", 2.0), -2.0)"}, before=11, table="swf")
_ranges = [f"range_{n}_{s}" for n in (20, 50) for s in ("high", "low", "pct", "breakout_up", "breakout_down", "inside")]
_range_steps = [stc.range_breakout(20), stc.range_breakout(50)]
_range_table = "(SELECT *, " + ", ".join(
    f"{roll('max', 'high', n, shift=1)} AS h{n}, {roll('min', 'low', n, shift=1)} AS l{n}" for n in (20, 50)) + " FROM b)"
_range_sql = {}
for _n in (20, 50):
    _range_sql |= {
        f"range_{_n}_high": f"h{_n}", f"range_{_n}_low": f"l{_n}", f"range_{_n}_pct": f"(h{_n} - l{_n}) / nullif(close, 0)",
        f"range_{_n}_breakout_up": fl(f"close > h{_n}"), f"range_{_n}_breakout_down": fl(f"close < l{_n}"),
        f"range_{_n}_inside": fl(f"close >= l{_n} AND close <= h{_n}"),
        f"range_{_n}_sweep_up": fl(f"high > h{_n} AND close < h{_n}"),
        f"range_{_n}_sweep_down": fl(f"low < l{_n} AND close > l{_n}")}
bar_query("f23_range_breakout", _ranges, _range_steps, ["b"], _range_sql, before=51, table=_range_table)
bar_query("f24_liquidity_sweep", [f"range_{n}_sweep_{s}" for n in (20, 50) for s in ("up", "down")], _range_steps, ["b"],
          _range_sql, before=51, table=_range_table)
bar_query("f25_fair_value_gap", ["smc_fvg_up_proxy", "smc_fvg_down_proxy"], [stc.add_gaps], ["b"],
          {"smc_fvg_up_proxy": fl(f"low > {lagged('high', 2)}"), "smc_fvg_down_proxy": fl(f"high < {lagged('low', 2)}")},
          before=2)
bar_query("f26_order_block", ["smc_order_block_up_proxy", "smc_order_block_down_proxy"], [stc.add_order_blocks], ["b"],
          {"smc_order_block_up_proxy": f"coalesce({lagged('u', 3)}, 0)", "smc_order_block_down_proxy": f"coalesce({lagged('w', 3)}, 0)"},
          before=6, table=f"(SELECT *, {fl('close < open AND r3 > 0.02', 'u')}, {fl('close > open AND r3 < -0.02', 'w')} "
                          f"FROM (SELECT *, close / nullif({lagged('close', 3)}, 0) - 1 AS r3 FROM b))")
bar_query("f27_change_of_character", ["smc_choch_up_proxy", "smc_choch_down_proxy"], [stc.add_character_change], ["sw"],
          {"smc_choch_up_proxy": fl(f"close > {ffill('sh5', strict=True)} AND {ffill('sl5', strict=True)} IS NOT NULL"),
           "smc_choch_down_proxy": fl(f"close < {ffill('sl5', strict=True)} AND {ffill('sh5', strict=True)} IS NOT NULL")},
          before=6, table="sw")

# --- candles ------------------------------------------------------------------------

fragment("cd", ("b",), f"""
cd AS MATERIALIZED (
  SELECT *, abs(close - open) AS body, nullif(high - low, 0) AS rng, high - greatest(open, close) AS up,
         least(open, close) - low AS lo, {lagged('open')} AS po, {lagged('high')} AS ph,
         {lagged('low')} AS pl, {lagged('close')} AS pc FROM b)""")
bar_query("f28_candle_anatomy", ["candle_body_pct", "candle_upper_wick_pct", "candle_lower_wick_pct", "candle_bullish",
                                 "candle_bearish"], [pat.add_anatomy], ["cd"],
          {"candle_body_pct": "body / rng", "candle_upper_wick_pct": "up / rng", "candle_lower_wick_pct": "lo / rng",
           "candle_bullish": fl("close > open"), "candle_bearish": fl("close < open")}, table="cd")
bar_query("f29_doji", ["doji"], [pat.add_single_bar_patterns], ["cd"], {"doji": fl("body / rng < 0.1")}, table="cd")
bar_query("f30_hammer", ["hammer"], [pat.add_single_bar_patterns], ["cd"],
          {"hammer": fl("lo >= 2 * body AND up <= body AND body / rng < 0.4")}, table="cd")
bar_query("f31_shooting_star", ["shooting_star"], [pat.add_single_bar_patterns], ["cd"],
          {"shooting_star": fl("up >= 2 * body AND lo <= body AND body / rng < 0.4")}, table="cd")
bar_query("f32_engulfing", ["bullish_engulfing", "bearish_engulfing"], [pat.add_two_bar_patterns], ["cd"],
          {"bullish_engulfing": fl("pc < po AND close > open AND open <= pc AND close >= po"),
           "bearish_engulfing": fl("pc > po AND close < open AND open >= pc AND close <= po")}, before=1, table="cd")
bar_query("f33_inside_outside_bar", ["inside_bar", "outside_bar"], [pat.add_two_bar_patterns], ["cd"],
          {"inside_bar": fl("high <= ph AND low >= pl"), "outside_bar": fl("high > ph AND low < pl")}, before=1, table="cd")
bar_query("f34_pin_bar", ["pin_bar"], [pat.add_single_bar_patterns], ["cd"],
          {"pin_bar": fl("(lo >= 2 * body AND up <= 0.5 * body) OR (up >= 2 * body AND lo <= 0.5 * body)")}, table="cd")
