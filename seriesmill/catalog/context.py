"""Joins J1-J5, context features F35-F46 and the composed matrix F47."""

from __future__ import annotations

from pyspark.sql import functions as F

from seriesmill.catalog.base import fl, fragment, hourly_bars, lagged, out_columns, query, r6, roll, running, sql
from seriesmill.catalog.features import DAILY, HOURLY, MATRIX_SQL
from seriesmill.functions.scalar import last_anchor, to_ms
from seriesmill.keys import ANCHOR_DATES
from seriesmill.operators import context as ctx, indicators as ind
from seriesmill.operators.asof import asof_columns
from seriesmill.operators.matrix import feature_matrix
from seriesmill.sources import given
from seriesmill.sources.ticks import bars, daily_bars

DAY_ANCHORS = ("1996-01-01", "1999-01-01")


def _feed(name: str, kind: str, cols: str) -> None:
    fragment(name, (), f"""
{name} AS (SELECT ts, {cols} FROM events WHERE event_type = '{kind}'
           QUALIFY row_number() OVER (PARTITION BY ts ORDER BY event_id DESC) = 1)""")


_feed("fund", "error", "(value - 50) / 100000 AS fr")
_feed("oi", "click", "value + 1000 AS oi, (value + 1000) * 2 AS oiu")
_feed("lsg", "view", "value / 500 AS gl, 1 - value / 500 AS gs, value / 50 AS gr")
_feed("lst", "signup", "value / 500 AS tl, 1 - value / 500 AS tsh, value / 40 AS tlr")
_feed("tk", "purchase", "CASE WHEN user_id % 2 = 0 THEN value ELSE 0 END AS buy, "
                        "CASE WHEN user_id % 2 = 0 THEN 0 ELSE value END AS sell, "
                        "CASE WHEN user_id % 2 = 0 THEN 1.0 ELSE 0.0 END AS bsr")
fragment("fb", ("b", "fund", "oi", "lsg", "lst", "tk"), f"""
fb AS MATERIALIZED (
  SELECT b.*, fr, oi, oiu, gl, gs, gr, tl, tsh, tlr, buy, sell, bsr
  FROM b ASOF LEFT JOIN fund ON b.ts >= fund.ts ASOF LEFT JOIN oi ON b.ts >= oi.ts
  ASOF LEFT JOIN lsg ON b.ts >= lsg.ts ASOF LEFT JOIN lst ON b.ts >= lst.ts ASOF LEFT JOIN tk ON b.ts >= tk.ts)""")
fragment("day", (), """
day AS MATERIALIZED (SELECT date_trunc('day', o_orderdate)::TIMESTAMP AS ts, max(o_totalprice) AS v FROM orders GROUP BY 1)""")
fragment("anchor_days", (), "anchor_days AS (SELECT * FROM (VALUES (TIMESTAMP '1996-01-01'), (TIMESTAMP '1999-01-01')) a(adate))")


def flow_query(name, columns, steps, exprs, before=51):
    MATRIX_SQL.update({c: (("cx",), "cx", exprs[c]) for c in columns})
    text = sql(["fb"], f"SELECT symbol, ts_ms, {', '.join(r6(exprs[c], c, 8) for c in columns)} FROM fb")

    @query(name, text)
    def run(spark, sf_dir):
        joined = ctx.join_derivatives(bars(spark, sf_dir), given.derivative_feeds(spark, sf_dir), grid_ms=HOURLY.step_ms)
        return out_columns(ind.on_bars(joined, HOURLY, *steps, before=before), columns, digits=8)


_deriv = {"deriv_funding_rate": "fr", "deriv_open_interest": "oi", "deriv_open_interest_usd": "oiu",
          "deriv_global_long_account_pct": "gl", "deriv_global_short_account_pct": "gs",
          "deriv_global_long_short_ratio": "gr", "deriv_top_long_position_pct": "tl",
          "deriv_top_short_position_pct": "tsh", "deriv_top_long_short_ratio": "tlr",
          "deriv_taker_buy_volume": "buy", "deriv_taker_sell_volume": "sell", "deriv_taker_buy_sell_ratio": "bsr"}


@query("j1_asof_join", sql(["fb"], f"SELECT symbol, ts_ms, {', '.join(r6(e, c, 8) for c, e in _deriv.items())} FROM fb"))
def j1(spark, sf_dir):
    """Every bar with the latest row of five irregular feeds."""
    joined = ctx.join_derivatives(bars(spark, sf_dir), given.derivative_feeds(spark, sf_dir), grid_ms=HOURLY.step_ms)
    return out_columns(joined, list(_deriv), digits=8)


@query("j1b_asof_single_series", sql(["d", "day"], f"""
SELECT symbol, ts_ms, {r6('day.v', 'value', 4)}, {r6('sparse.v', 'sparse', 4)}
FROM d ASOF LEFT JOIN day ON d.ts >= day.ts
ASOF LEFT JOIN (SELECT ts, CASE WHEN day(ts) % 7 <> 0 THEN v END AS v FROM day) sparse ON d.ts >= sparse.ts"""))
def j1b(spark, sf_dir):
    """Two market-wide series in one union; a missing value in the latest row stays missing."""
    feeds = {"a": given.daily_series(spark, sf_dir),
             "b": given.sparse_series(spark, sf_dir).withColumnRenamed("value", "sparse")}
    return out_columns(asof_columns(daily_bars(spark, sf_dir), feeds), ["value", "sparse"], digits=4)


def _spot_futures(spark, sf_dir):
    """The bar table as futures and, two symbols renamed alike, every third bar as spot."""
    futures = bars(spark, sf_dir)
    spot = futures.where(F.pmod(F.floor(F.unix_seconds("ts") / 3600), F.lit(3)) == 0).select(
        "symbol", "ts", F.col("open").alias("spot_close"))
    return asof_columns(futures, {"spot": spot}, on=("symbol",))


_spot_sql = """(SELECT b.*, s.open AS spot FROM b ASOF LEFT JOIN
  (SELECT symbol, ts, open FROM b WHERE (epoch(ts)::BIGINT // 3600) % 3 = 0) s ON b.symbol = s.symbol AND b.ts >= s.ts)"""


@query("j2_forward_fill_reindex", sql(["b"], f"SELECT symbol, ts_ms, {r6('spot', 'spot_close')} FROM {_spot_sql}"))
def j2(spark, sf_dir):
    return out_columns(_spot_futures(spark, sf_dir), ["spot_close"])


@query("j4_feature_block_concat", sql(["bb"], f"SELECT symbol, ts_ms, {r6('mid', 'bb_mid')}, {fl('close > open', 'candle_bullish')}, {r6(roll('avg', 'close', 50), 'sma_50')} FROM bb"))
def j4(spark, sf_dir):
    """Blocks from different operators side by side: one exchange, no join."""
    from seriesmill.operators import patterns as pat
    df = ind.on_bars(bars(spark, sf_dir), HOURLY, ind.add_bollinger, pat.add_anatomy, ind.add_sma, before=200)
    return out_columns(df, ["bb_mid", "candle_bullish", "sma_50"])


@query("j5_last_anchor", sql(["d", "anchor_days"], """
SELECT symbol, ts_ms, (SELECT max(epoch_ms(adate)) FROM anchor_days WHERE adate <= d.ts) AS anchor_ms FROM d"""))
def j5(spark, sf_dir):
    df = daily_bars(spark, sf_dir)
    return df.select("symbol", to_ms(F.col("ts")).alias("ts_ms"),
                     to_ms(last_anchor(F.col("ts"), DAY_ANCHORS)).alias("anchor_ms"))


# --- derivatives --------------------------------------------------------------------

_z = lambda x, n: f"({x} - ({roll('avg', x, n)})) / nullif({roll('stddev_pop', x, n)}, 0)"
_pc = lambda x: f"{x} / nullif({lagged(x)}, 0) - 1"
flow_query("f35_funding", ["funding_rate", "funding_rate_zscore_50", "funding_extreme_high", "funding_extreme_low",
                           "funding_rate_8h_delta"], [ctx.add_funding],
           {"funding_rate": "fr", "funding_rate_zscore_50": _z("fr", 50), "funding_extreme_high": fl("fr > 0.0003::DOUBLE"),
            "funding_extreme_low": fl("fr < -0.0003::DOUBLE"), "funding_rate_8h_delta": f"fr - {lagged('fr')}"})
flow_query("f36_open_interest", ["open_interest", "open_interest_change_pct", "open_interest_zscore_50"],
           [ctx.add_open_interest],
           {"open_interest": "oi", "open_interest_change_pct": _pc("oi"), "open_interest_zscore_50": _z("oi", 50)})
flow_query("f37_price_oi_quadrants", ["price_up_oi_up", "price_up_oi_down", "price_down_oi_up", "price_down_oi_down"],
           [ctx.add_price_oi_quadrants],
           {f"price_{p}_oi_{o}": fl(f"{_pc('close')} {'>' if p == 'up' else '<'} 0 AND {_pc('oi')} {'>' if o == 'up' else '<'} 0")
            for p in ("up", "down") for o in ("up", "down")})
flow_query("f38_taker_flow", ["taker_delta_proxy", "cvd_proxy", "taker_imbalance"], [ctx.add_taker],
           {"taker_delta_proxy": "buy - sell",
            "cvd_proxy": f"CASE WHEN buy IS NOT NULL THEN {running('sum', '(buy - sell)')} END",
            "taker_imbalance": "(buy - sell) / nullif(buy + sell, 0)"})
_ls = ["deriv_global_long_account_pct", "deriv_global_short_account_pct", "deriv_global_long_short_ratio",
       "deriv_top_long_position_pct", "deriv_top_short_position_pct", "deriv_top_long_short_ratio"]
flow_query("f39_long_short_ratios", [*_ls, "global_long_short_zscore_50"], [ctx.add_long_short],
           {**_deriv, "global_long_short_zscore_50": _z("gr", 50)})
flow_query("f40_funding_oi_governor", ["funding_oi_governor_risk"],
           [ctx.add_funding, ctx.add_open_interest, ctx.add_governor],
           {"funding_oi_governor_risk": fl(f"coalesce(fr > 0.0003::DOUBLE, FALSE) OR coalesce(fr < -0.0003::DOUBLE, FALSE) "
                                           f"OR abs(coalesce({_z('oi', 50)}, 0)) > 2.0::DOUBLE + 1e-12")})


@query("f41_basis", sql(["b"], f"SELECT symbol, ts_ms, {r6('(close - spot) / nullif(spot, 0)', 'basis_futures_vs_spot')} FROM {_spot_sql}"))
def f41(spark, sf_dir):
    return out_columns(ctx.add_basis(_spot_futures(spark, sf_dir), HOURLY), ["basis_futures_vs_spot"])


# --- daily context ------------------------------------------------------------------

def _shift(k: int, factor: float) -> str:
    return f"(SELECT ts + INTERVAL {k} DAY AS ts, v * {factor} AS v FROM day)"


def daily_query(name, columns, prepare, steps, deps, table, exprs, before=31, digits=4):
    text = sql(deps, f"SELECT symbol, ts_ms, {', '.join(r6(exprs[c], c, digits) for c in columns)} FROM {table}")

    @query(name, text)
    def run(spark, sf_dir):
        df = ind.on_bars(prepare(spark, sf_dir), DAILY, *steps, before=before)
        return out_columns(df, columns, digits=digits)


def _onchain(spark, sf_dir):
    feeds = {m: given.shifted_series(spark, sf_dir, k, k + 1.0) for k, m in enumerate(ctx.ONCHAIN_BTC)}
    feeds["eth_supply"] = given.sparse_series(spark, sf_dir)
    return ctx.join_series(daily_bars(spark, sf_dir), feeds, ctx.ONCHAIN_BTC + ctx.ONCHAIN_ETH, grid_ms=DAILY.step_ms)


_chain_table = "(SELECT d.*, " + ", ".join(f"m{k}.v AS x{k}" for k in range(7)) + ", sp.v AS eth FROM d " + " ".join(
    f"ASOF LEFT JOIN {_shift(k, k + 1)} m{k} ON d.ts >= m{k}.ts" for k in range(7)) + \
    " ASOF LEFT JOIN (SELECT ts, CASE WHEN day(ts) % 7 <> 0 THEN v END AS v FROM day) sp ON d.ts >= sp.ts)"
_chain = {}
for _k, _m in enumerate(ctx.ONCHAIN_BTC):
    _chain |= {_m: f"x{_k}", f"{_m}_zscore_30": _z(f"x{_k}", 30), f"{_m}_delta": f"x{_k} - {lagged(f'x{_k}')}"}
_chain["eth_supply"] = "eth"
daily_query("f42_onchain", list(_chain), _onchain, [ctx.add_onchain], ["d", "day"], _chain_table, _chain)


def _sentiment(spark, sf_dir):
    return ctx.join_series(daily_bars(spark, sf_dir), {"fear_greed": given.fear_greed_series(spark, sf_dir)}, ["fear_greed"], grid_ms=DAILY.step_ms)


_fg = ["fear_greed", "fear_greed_zscore_30", "fear_greed_delta", "fear_greed_extreme_fear", "fear_greed_extreme_greed"]
daily_query("f43_fear_greed", _fg, _sentiment, [ctx.add_sentiment], ["d", "day"],
            "(SELECT d.*, s.fg FROM d ASOF LEFT JOIN (SELECT ts, CAST(floor(v)::BIGINT % 101 AS DOUBLE) AS fg FROM day) s ON d.ts >= s.ts)",
            {"fear_greed": "fg", "fear_greed_zscore_30": _z("fg", 30), "fear_greed_delta": f"fg - {lagged('fg')}",
             "fear_greed_extreme_fear": fl("fg < 20"), "fear_greed_extreme_greed": fl("fg > 80")})


def _macro(spark, sf_dir):
    feeds = {m: given.shifted_series(spark, sf_dir, 2 * k, k + 1.0) for k, m in enumerate(ctx.MACRO)}
    return ctx.join_series(daily_bars(spark, sf_dir), feeds, ctx.MACRO, prefix="macro_", grid_ms=DAILY.step_ms)


_macro_sql = {f"macro_{m}": f"x{k}" for k, m in enumerate(ctx.MACRO)} | {
    f"macro_{m}_ret": _pc(f"x{k}") for k, m in enumerate(ctx.MACRO) if m in ctx.MACRO_RETURNS}
daily_query("f44_macro", list(_macro_sql), _macro, [ctx.add_macro_returns], ["d", "day"],
            "(SELECT d.*, " + ", ".join(f"m{k}.v AS x{k}" for k in range(6)) + " FROM d " + " ".join(
                f"ASOF LEFT JOIN {_shift(2 * k, k + 1)} m{k} ON d.ts >= m{k}.ts" for k in range(6)) + ")", _macro_sql)


def _dominance(spark, sf_dir):
    feeds = {m: given.shifted_series(spark, sf_dir, k, 1.0 / (k + 1)) for k, m in enumerate(ctx.DOMINANCE)}
    return ctx.join_series(daily_bars(spark, sf_dir), feeds, ctx.DOMINANCE, grid_ms=DAILY.step_ms)


daily_query("f45_dominance", list(ctx.DOMINANCE), _dominance, [], ["d", "day"],
            "(SELECT d.*, " + ", ".join(f"m{k}.v AS x{k}" for k in range(4)) + " FROM d " + " ".join(
                f"ASOF LEFT JOIN {_shift(k, 1.0 / (k + 1))} m{k} ON d.ts >= m{k}.ts" for k in range(4)) + ")",
            {m: f"x{k}" for k, m in enumerate(ctx.DOMINANCE)}, before=0)


@query("f46_months_since_anchor", sql(["d", "anchor_days"], f"""
SELECT symbol, ts_ms, {r6('floor((epoch(ts) - epoch(a)) / 86400) / 30.4375', 'cycle_months_since_halving')}
FROM (SELECT d.*, (SELECT max(adate) FROM anchor_days WHERE adate <= d.ts) AS a FROM d)"""))
def f46(spark, sf_dir):
    return out_columns(ctx.cycle_months(DAY_ANCHORS)(daily_bars(spark, sf_dir), DAILY), ["cycle_months_since_halving"])


# --- composer -----------------------------------------------------------------------

def hourly_matrix(spark, sf_dir):
    """The full matrix on hourly bars with every feed and a spot table."""
    rows = hourly_bars(spark, sf_dir)
    feeds = given.derivative_feeds(spark, sf_dir) | given.context_series(spark, sf_dir)
    return feature_matrix(rows, HOURLY, feeds, given.spot_bars(rows))


fragment("h6", (), """
h6 AS MATERIALIZED (SELECT time_bucket(INTERVAL 6 HOUR, ts) AS ts, last(value ORDER BY ts, event_id) AS v FROM events GROUP BY 1)""")
_series = [*ctx.ONCHAIN_BTC, *ctx.ONCHAIN_ETH, *(f"macro_{m}" for m in ctx.MACRO), *ctx.DOMINANCE]
_feeds_sql = [f"(SELECT ts + INTERVAL {k} HOUR AS ts, {f'CASE WHEN day(ts) % 7 <> 0 THEN v * {k + 1.0} END' if c == 'eth_supply' else f'v * {k + 1.0}'} AS {c} FROM h6)"
              for k, c in enumerate(_series)]
_feeds_sql.append("(SELECT ts, CAST(floor(v)::BIGINT % 101 AS DOUBLE) AS fear_greed FROM h6)")
fragment("cx", ("fb", "h6"), "cx AS MATERIALIZED (SELECT fb.*, " + ", ".join([*_series, "fear_greed", "spot"]) + " FROM fb "
         + " ".join(f"ASOF LEFT JOIN {f} f{k} ON fb.ts >= f{k}.ts" for k, f in enumerate(_feeds_sql))
         + " ASOF LEFT JOIN (SELECT symbol, ts, open AS spot FROM b WHERE (epoch(ts)::BIGINT // 3600) % 3 = 0) s ON fb.symbol = s.symbol AND fb.ts >= s.ts)")
_of_context = {c: c for c in [*_series, "fear_greed"]} | {"basis_futures_vs_spot": "(close - spot) / nullif(spot, 0)"} | _deriv
for _m in ctx.ONCHAIN_BTC:
    _of_context |= {f"{_m}_zscore_30": _z(_m, 30), f"{_m}_delta": f"{_m} - {lagged(_m)}"}
_of_context |= {f"macro_{m}_ret": _pc(f"macro_{m}") for m in ctx.MACRO_RETURNS}
_of_context |= {"fear_greed_zscore_30": _z("fear_greed", 30), "fear_greed_delta": f"fear_greed - {lagged('fear_greed')}",
                "fear_greed_extreme_fear": fl("fear_greed < 20"), "fear_greed_extreme_greed": fl("fear_greed > 80")}
_anchor = "greatest(" + ", ".join(f"CASE WHEN TIMESTAMP '{a}' <= ts THEN TIMESTAMP '{a}' END" for a in ANCHOR_DATES) + ")"
_of_context["cycle_months_since_halving"] = f"floor((epoch(ts) - epoch({_anchor})) / 86400) / 30.4375"
MATRIX_SQL.update({c: (("cx",), "cx", e) for c, e in _of_context.items()} | {c: (("b",), "b", c) for c in ("open", "high", "low", "close", "volume")})

# The columns of the matrix.
MATRIX_COLUMNS = (
    "open", "high", "low", "close", "volume", *_deriv, *_series[:12], "fear_greed", *_series[12:], "swing_high_flag", "swing_low_flag",
    "taker_delta_proxy", "taker_imbalance", "obv", "last_swing_high", "last_swing_low", "distance_from_ath_pct", "distance_from_atl_pct",
    "distance_to_last_swing_high", "distance_to_last_swing_low", "swing_hh_flag", "swing_lh_flag", "swing_hl_flag", "swing_ll_flag",
    "smc_choch_up_proxy", "smc_choch_down_proxy", "cvd_proxy", "market_structure_score",
    *(f"distance_from_{k}_{s}" for k in ("52w_24h", "52w_1h", "52w_4h") for s in ("high", "low")), "returns_1", "log_returns_1",
    "sma_50", "sma_200", "bb_mid", "bb_upper", "bb_lower", "true_range", "volume_log", "volume_zscore_20", "volume_zscore_50", "vwap_24", "vwap_72",
    "range_20_high", "range_20_low", "range_50_high", "range_50_low", "smc_fvg_up_proxy", "smc_fvg_down_proxy", "candle_body_pct",
    "candle_upper_wick_pct", "candle_lower_wick_pct", "candle_bullish", "candle_bearish", "doji", "hammer", "shooting_star", "pin_bar",
    "bullish_engulfing", "bearish_engulfing", "inside_bar", "outside_bar", "fear_greed_zscore_30", "fear_greed_delta",
    "fear_greed_extreme_fear", "fear_greed_extreme_greed", *(f"{m}_{s}" for m in ctx.ONCHAIN_BTC for s in ("zscore_30", "delta")),
    *(f"macro_{m}_ret" for m in ctx.MACRO_RETURNS), "cycle_months_since_halving", "funding_rate", "funding_rate_zscore_50",
    "funding_extreme_high", "funding_extreme_low", "funding_rate_8h_delta", "open_interest", "open_interest_change_pct",
    "open_interest_zscore_50", *(f"price_{p}_oi_{o}" for p in ("up", "down") for o in ("up", "down")), "global_long_short_zscore_50",
    "basis_futures_vs_spot", "ema_9", "ema_21", "ema_50", "ema_120", "ema_200", "atr", "ema_stack_score", "price_above_ema_200",
    "price_above_ema_120", "ema_120_cycle_signal", "golden_cross", "death_cross", "rsi_14", "macd_line", "bb_pct_b", "bb_bandwidth",
    "bb_mean_reversion_signal", "atr_pct", "volume_spike", "realized_volatility_20", "realized_volatility_50", "realized_volatility_100",
    "realized_volatility", *(f"range_{n}_{s}" for n in (20, 50) for s in ("pct", "breakout_up", "breakout_down", "inside", "sweep_up", "sweep_down")),
    "smc_order_block_up_proxy", "smc_order_block_down_proxy", "funding_oi_governor_risk", "macd_signal", "rsi_14_slope", "rsi_14_overbought",
    "rsi_14_oversold", "rsi_14_zscore_50", "macd_hist", "macd_hist_slope", "macd_cross_up", "macd_cross_down")


def _matrix_sql() -> None:
    """CTE ``fmx``: keys and every matrix column, one part per table the columns come from."""
    tables: dict[str, tuple[list[str], list[str]]] = {}
    for c in MATRIX_COLUMNS:
        deps, table, expr = MATRIX_SQL[c]
        needs, exprs = tables.setdefault(table, ([], []))
        needs.extend(deps)
        exprs.append(f"CAST({expr} AS DOUBLE) AS {c}")
    parts = []
    for k, (table, (needs, exprs)) in enumerate(tables.items()):
        fragment(f"fp{k}", tuple(dict.fromkeys(needs)), f"fp{k} AS MATERIALIZED (SELECT symbol, i, {', '.join(exprs)} FROM {table})")
        parts.append(f"fp{k}")
    fragment("fmx", ("b", *parts), "fmx AS MATERIALIZED (SELECT b.symbol, b.i, b.n, b.ts, b.ts_ms, " + ", ".join(MATRIX_COLUMNS)
             + " FROM (SELECT symbol, i, n, ts, ts_ms FROM b) b " + " ".join(f"JOIN {p} USING (symbol, i)" for p in parts) + ")")


_matrix_sql()
fragment("swx", ("sw",), "swx AS MATERIALIZED (SELECT *, last_value(sh IGNORE NULLS) OVER (PARTITION BY symbol ORDER BY i "
                         "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS lsh FROM sw)")


@query("f47_feature_matrix", sql(["fmx"], f"SELECT symbol, ts_ms, {', '.join(r6(c, c, 8) for c in MATRIX_COLUMNS)} FROM fmx"))
def f47(spark, sf_dir):
    """All blocks composed, every column."""
    return out_columns(hourly_matrix(spark, sf_dir), MATRIX_COLUMNS, digits=8)
