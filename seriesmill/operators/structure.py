"""Market structure: swings, ranges, breakouts and simplified order-flow proxies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from seriesmill.functions.scalar import flag, safe_div
from seriesmill.plans.blocks import Feature, Layout, Rolling, RunStep, Running, lag, pct_change


def swing_high(L: Layout, size: int) -> Column:
    """High above all ``size`` bars before it."""
    return flag(F.col("high") > Rolling(L, size, shift=1).max("high"))


def swing_low(L: Layout, size: int) -> Column:
    return flag(F.col("low") < Rolling(L, size, shift=1).min("low"))


def _swing_levels(df: DataFrame, L: Layout, size: int = 10) -> DataFrame:
    df = df.withColumns({"swing_high_flag": swing_high(L, size), "swing_low_flag": swing_low(L, size)})
    return df.withColumns({
        "_sh": F.when(F.col("swing_high_flag") > 0, F.col("high")),
        "_sl": F.when(F.col("swing_low_flag") > 0, F.col("low")),
    })


def _swing_features(df: DataFrame, L: Layout) -> DataFrame:
    return df.withColumns({
        "distance_to_last_swing_high": safe_div(F.col("close"), F.col("last_swing_high")) - 1,
        "distance_to_last_swing_low": safe_div(F.col("close"), F.col("last_swing_low")) - 1,
        "swing_hh_flag": flag(F.col("_sh") > F.col("_prev_sh")),
        "swing_lh_flag": flag(F.col("_sh") < F.col("_prev_sh")),
        "swing_hl_flag": flag(F.col("_sl") > F.col("_prev_sl")),
        "swing_ll_flag": flag(F.col("_sl") < F.col("_prev_sl")),
    }).drop("_sh", "_sl", "_prev_sh", "_prev_sl")


# swing flags, the last swing levels, the close's distance to them, and how each swing
# compares with the one before
add_swings = RunStep(_swing_levels, {
    "last_swing_high": Running("last", "_sh"), "last_swing_low": Running("last", "_sl"),
    "_prev_sh": Running("last", "_sh", strict=True), "_prev_sl": Running("last", "_sl", strict=True),
}, _swing_features)


def _score(df: DataFrame, L: Layout) -> DataFrame:
    score = F.col("_seen_hh") + F.col("_seen_hl") - F.col("_seen_lh") - F.col("_seen_ll")
    held = F.greatest(F.least(score, F.lit(2.0)), F.lit(-2.0))
    return df.withColumn("market_structure_score", held).drop("_seen_hh", "_seen_hl", "_seen_lh", "_seen_ll")


# each swing flag latches once seen; the score is their signed sum, held in -2..2
add_structure_score = RunStep(
    lambda df, L: df, {f"_seen_{k}": Running("max", f"swing_{k}_flag") for k in ("hh", "hl", "lh", "ll")}, _score)


def range_breakout(size: int) -> Feature:
    """Range of the bars before, breakouts from it and sweeps through it."""
    name = f"range_{size}"

    def bounds(L: Layout) -> dict[str, Column]:
        prior = Rolling(L, size, shift=1)
        return {f"{name}_high": prior.max("high"), f"{name}_low": prior.min("low")}

    def events(_: Layout) -> dict[str, Column]:
        top, bottom = F.col(f"{name}_high"), F.col(f"{name}_low")
        close, high, low = F.col("close"), F.col("high"), F.col("low")
        return {
            f"{name}_pct": safe_div(top - bottom, close),
            f"{name}_breakout_up": flag(close > top),
            f"{name}_breakout_down": flag(close < bottom),
            f"{name}_inside": flag((close >= bottom) & (close <= top)),
            f"{name}_sweep_up": flag((high > top) & (close < top)),
            f"{name}_sweep_down": flag((low < bottom) & (close > bottom)),
        }

    return Feature(bounds, derived=events)


add_gaps = Feature(lambda L: {
    "smc_fvg_up_proxy": flag(F.col("low") > lag(L, "high", 2)),
    "smc_fvg_down_proxy": flag(F.col("high") < lag(L, "low", 2)),
})


def _opposing_moves(L: Layout) -> dict[str, Column]:
    move = pct_change(L, "close", 3)
    return {"_ob_up": flag((F.col("close") < F.col("open")) & (move > 0.02)),
            "_ob_dn": flag((F.col("close") > F.col("open")) & (move < -0.02))}


# opposing candle with a 2 % trailing three-bar move, reported three bars later
add_order_blocks = Feature(_opposing_moves, derived=lambda L: {
    "smc_order_block_up_proxy": F.coalesce(lag(L, "_ob_up", 3), F.lit(0.0)),
    "smc_order_block_down_proxy": F.coalesce(lag(L, "_ob_dn", 3), F.lit(0.0)),
}, drop=("_ob_up", "_ob_dn"))


def _short_swings(df: DataFrame, L: Layout, size: int = 5) -> DataFrame:
    return df.withColumns({
        "_top5": F.when(swing_high(L, size) > 0, F.col("high")),
        "_bottom5": F.when(swing_low(L, size) > 0, F.col("low")),
    })


def _character_flags(df: DataFrame, L: Layout) -> DataFrame:
    top, bottom, close = F.col("_top"), F.col("_bottom"), F.col("close")
    return df.withColumns({
        "smc_choch_up_proxy": flag((close > top) & bottom.isNotNull()),
        "smc_choch_down_proxy": flag((close < bottom) & top.isNotNull()),
    }).drop("_top", "_bottom", "_top5", "_bottom5")


# close beyond the last swing level known before this bar, once both levels exist
add_character_change = RunStep(_short_swings, {
    "_top": Running("last", "_top5", strict=True), "_bottom": Running("last", "_bottom5", strict=True),
}, _character_flags)
