"""Candle anatomy and candlestick pattern flags."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from seriesmill.functions.scalar import flag, safe_div
from seriesmill.plans.blocks import Feature, Layout, lag

def _parts():
    body = F.abs(F.col("close") - F.col("open"))
    size = F.nullif(F.col("high") - F.col("low"), F.lit(0.0))
    upper = F.col("high") - F.greatest("open", "close")
    lower = F.least("open", "close") - F.col("low")
    return body, size, upper, lower


def _anatomy(_: Layout) -> dict[str, Column]:
    body, size, upper, lower = _parts()
    return {
        "candle_body_pct": safe_div(body, size),
        "candle_upper_wick_pct": safe_div(upper, size),
        "candle_lower_wick_pct": safe_div(lower, size),
        "candle_bullish": flag(F.col("close") > F.col("open")),
        "candle_bearish": flag(F.col("close") < F.col("open")),
    }


def _single_bar(_: Layout) -> dict[str, Column]:
    body, size, upper, lower = _parts()
    share = safe_div(body, size)
    long_lower, long_upper = lower >= 2 * body, upper >= 2 * body
    return {
        "doji": flag(share < 0.1),
        "hammer": flag(long_lower & (upper <= body) & (share < 0.4)),
        "shooting_star": flag(long_upper & (lower <= body) & (share < 0.4)),
        "pin_bar": flag((long_lower & (upper <= 0.5 * body)) | (long_upper & (lower <= 0.5 * body))),
    }


def _two_bars(L: Layout) -> dict[str, Column]:
    o, h, lo, c = (F.col(x) for x in ("open", "high", "low", "close"))
    po, ph, pl, pc = (lag(L, x) for x in ("open", "high", "low", "close"))
    return {
        "bullish_engulfing": flag((pc < po) & (c > o) & (o <= pc) & (c >= po)),
        "bearish_engulfing": flag((pc > po) & (c < o) & (o >= pc) & (c <= po)),
        "inside_bar": flag((h <= ph) & (lo >= pl)),
        "outside_bar": flag((h > ph) & (lo < pl)),
    }


add_anatomy = Feature(_anatomy)
add_single_bar_patterns = Feature(_single_bar)
add_two_bar_patterns = Feature(_two_bars)
