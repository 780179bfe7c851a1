"""Causal technical indicators on bars laid out in blocks.

Each ``add_*`` is applied to a blocked frame and its layout and adds its columns; all share
one window specification, so Spark needs one exchange and one sort for them together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from seriesmill.functions.scalar import TIE, flag, safe_div
from seriesmill.plans.blocks import (
    Feature, Layout, Rolling, RunStep, Running, Smooth, ema_reach, from_blocks, lag, pct_change,
    span, to_blocks, with_long_rolling,
)

EMA_SPANS = (9, 21, 50, 120, 200)
WILDER = 1.0 / 14
# the longest smoothing average, then the longest window on top of one
EMA_LOOKBACK = ema_reach(span(200)) + 256
RSI_LOOKBACK = ema_reach(WILDER) + 64
MACD_LOOKBACK = ema_reach(span(26)) + ema_reach(span(9)) + 8
ATR_LOOKBACK = ema_reach(WILDER) + 8
YEAR_WINDOWS = {"52w_24h": 365, "52w_1h": 365 * 24, "52w_4h": 365 * 6}


def require_columns(df: DataFrame, columns) -> DataFrame:
    """Fail while the plan is built when a required column is absent."""
    missing = sorted(set(columns) - set(df.columns))
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return df


def _log_return(L: Layout) -> Column:
    return F.ln("close") - lag(L, F.ln("close"))


add_returns = Feature(lambda L: {"returns_1": pct_change(L, "close"), "log_returns_1": _log_return(L)})


def ema(spans=EMA_SPANS) -> Feature:
    return Feature(smooth={f"ema_{n}": Smooth("close", span(n), n) for n in spans})


add_ema = ema()


def _order_sign(a: Column, b: Column) -> Column:
    return F.when(a > b, 1.0).when(a < b, -1.0).otherwise(0.0)


def cross_up(L: Layout, a: str, b: str) -> Column:
    return flag((F.col(a) > F.col(b)) & (lag(L, a) <= lag(L, b)))


def cross_down(L: Layout, a: str, b: str) -> Column:
    return flag((F.col(a) < F.col(b)) & (lag(L, a) >= lag(L, b)))


def _ema_state(L: Layout) -> dict[str, Column]:
    averages = [F.col(f"ema_{n}") for n in EMA_SPANS]
    score = F.lit(0.0)
    for shorter, longer in zip(averages, averages[1:]):
        score = score + _order_sign(shorter, longer)
    close = F.col("close")
    above_120 = flag(close > F.col("ema_120"))
    return {
        "ema_stack_score": score,
        "price_above_ema_200": flag(close > F.col("ema_200")),
        "price_above_ema_120": above_120,
        "ema_120_cycle_signal": above_120 * 2 - 1,
        "golden_cross": cross_up(L, "ema_50", "ema_200"),
        "death_cross": cross_down(L, "ema_50", "ema_200"),
    }


# stack score (-4..4), price against the long averages, 50/200 crosses
add_ema_state = Feature(derived=_ema_state)


def sma(sizes=(50, 200)) -> Feature:
    return Feature(lambda L: {f"sma_{n}": Rolling(L, n).mean("close") for n in sizes})


add_sma = sma()


def rsi(length: int = 14) -> Feature:
    def moves(L: Layout) -> dict[str, Column]:
        change = F.col("close") - lag(L, "close")
        return {"_gain": F.when(change.isNotNull(), F.greatest(change, F.lit(0.0))),
                "_loss": F.when(change.isNotNull(), F.greatest(-change, F.lit(0.0)))}

    def strength(_: Layout) -> dict[str, Column]:
        ratio = safe_div(F.col("_up"), F.col("_dn"))
        return {f"rsi_{length}": F.when(F.col("_dn") == 0, 100.0).otherwise(100.0 - 100.0 / (1.0 + ratio))}

    # the change exists from position 1 on, so do the averages
    averages = {"_up": Smooth("_gain", 1.0 / length, length, start=1), "_dn": Smooth("_loss", 1.0 / length, length, start=1)}
    return Feature(moves, averages, strength, drop=("_gain", "_loss", "_up", "_dn"))


def rsi_state(length: int = 14) -> Feature:
    name = f"rsi_{length}"
    return Feature(final=lambda L: {
        f"{name}_slope": F.col(name) - lag(L, name),
        f"{name}_overbought": flag(F.col(name) > 70),
        f"{name}_oversold": flag(F.col(name) < 30),
        f"{name}_zscore_50": Rolling(L, 50).zscore(name),
    })


add_rsi, add_rsi_state = rsi(), rsi_state()


def macd(fast: int = 12, slow: int = 26, signal: int = 9) -> Feature:
    def final(L: Layout) -> dict[str, Column]:
        hist = F.col("macd_line") - F.col("macd_signal")
        return {
            "macd_hist": hist,
            "macd_hist_slope": hist - lag(L, hist),
            "macd_cross_up": cross_up(L, "macd_line", "macd_signal"),
            "macd_cross_down": cross_down(L, "macd_line", "macd_signal"),
        }

    return Feature(
        smooth={"_fast": Smooth("close", span(fast), fast), "_slow": Smooth("close", span(slow), slow)},
        derived=lambda L: {"macd_line": F.col("_fast") - F.col("_slow")},
        smooth_again={"macd_signal": Smooth("macd_line", span(signal), signal, start=max(fast, slow) - 1)},
        final=final, drop=("_fast", "_slow"))


add_macd = macd()


def bollinger(size: int = 20, width: float = 2.0) -> Feature:
    def bands(L: Layout) -> dict[str, Column]:
        mid, spread = Rolling(L, size).mean("close"), Rolling(L, size).std("close")
        return {"bb_mid": mid, "bb_upper": mid + width * spread, "bb_lower": mid - width * spread}

    def state(_: Layout) -> dict[str, Column]:
        close, upper, lower = F.col("close"), F.col("bb_upper"), F.col("bb_lower")
        return {
            "bb_pct_b": safe_div(close - lower, upper - lower),
            "bb_bandwidth": safe_div(upper - lower, F.col("bb_mid")),
            "bb_mean_reversion_signal": F.when(close > upper, -1.0).when(close < lower, 1.0).otherwise(0.0),
        }

    return Feature(bands, derived=state)


add_bollinger = bollinger()


def _true_range(L: Layout) -> dict[str, Column]:
    before = lag(L, "close")
    return {"true_range": F.greatest(
        F.col("high") - F.col("low"), F.abs(F.col("high") - before), F.abs(F.col("low") - before))}


add_true_range = Feature(_true_range)


def atr(length: int = 14) -> Feature:
    return Feature(smooth={"atr": Smooth("true_range", 1.0 / length, length)},
                   derived=lambda L: {"atr_pct": safe_div(F.col("atr"), F.col("close"))})


add_atr = atr()
add_volume = Feature(
    lambda L: {"volume_log": F.log1p("volume"), "volume_zscore_20": Rolling(L, 20).zscore("volume"),
               "volume_zscore_50": Rolling(L, 50).zscore("volume")},
    derived=lambda L: {"volume_spike": flag(F.col("volume_zscore_20") > 2.0 + TIE)})


def _signed_volume(df: DataFrame, L: Layout) -> DataFrame:
    change = F.coalesce(F.col("close") - lag(L, "close"), F.lit(0.0))
    return df.withColumn("_signed", F.signum(change) * F.col("volume"))


add_obv = RunStep(_signed_volume, {"obv": Running("sum", "_signed")}, lambda df, L: df.drop("_signed"))


def vwap(sizes=(24, 72)) -> Feature:
    def averages(L: Layout) -> dict[str, Column]:
        traded = (F.col("high") + F.col("low") + F.col("close")) / 3.0 * F.col("volume")
        return {f"vwap_{n}": safe_div(Rolling(L, n).sum(traded), Rolling(L, n).sum("volume")) for n in sizes}

    return Feature(averages)


def volatility(sizes=(20, 50, 100)) -> Feature:
    def rolled(L: Layout) -> dict[str, Column]:
        out = {f"realized_volatility_{n}": Rolling(L, n).std("_log_return") for n in sizes}
        return {**out, "realized_volatility": out[f"realized_volatility_{sizes[0]}"]}

    return Feature(lambda L: {"_log_return": _log_return(L)}, derived=rolled, drop=("_log_return",))


add_vwap, add_volatility = vwap(), volatility()


def _extreme_distance(df: DataFrame, L: Layout) -> DataFrame:
    return df.withColumns({
        "distance_from_ath_pct": safe_div(F.col("close"), F.col("_ath")) - 1,
        "distance_from_atl_pct": safe_div(F.col("close"), F.col("_atl")) - 1,
    }).drop("_ath", "_atl")


add_extremes = RunStep(lambda df, L: df, {"_ath": Running("max", "close"), "_atl": Running("min", "close")},
                       _extreme_distance)


def add_year_extremes(df: DataFrame, L: Layout, windows=YEAR_WINDOWS) -> DataFrame:
    """Distance from the high/low of fixed bar counts; NULL while the series is shorter."""
    specs, out = {}, {}
    for name, n in windows.items():
        specs[f"_hi_{name}"] = ("max", "close", n)
        specs[f"_lo_{name}"] = ("min", "close", n)
        out[f"distance_from_{name}_high"] = safe_div(F.col("close"), F.col(f"_hi_{name}")) - 1
        out[f"distance_from_{name}_low"] = safe_div(F.col("close"), F.col(f"_lo_{name}")) - 1
    return with_long_rolling(df, L, specs).withColumns(out).drop(*specs)


def on_bars(bars: DataFrame, layout: Layout, *steps, before: int = 0, after: int = 0,
            keep_position: bool = False) -> DataFrame:
    """Lay bars out, run the steps on the blocks, and return one row per bar."""
    L = layout.reach(before, after)
    df = to_blocks(require_columns(bars, (*layout.keys, layout.ts)), L)
    for step in steps:
        df = step(df, L)
    return from_blocks(df, keep_position)
