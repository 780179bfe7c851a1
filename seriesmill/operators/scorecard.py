"""Rule-derived checklists: every field present, missing inputs reported as ``unavailable``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from seriesmill.functions.scalar import UNAVAILABLE, classify, rnd
from seriesmill.operators.rows import latest

# Thresholds and their labels.
STRUCTURE = [(-1.5, "lower_lows_lower_highs"), (-0.5, "weak_bear"), (0.5, "neutral"), (1.5, "weak_bull"),
             (2.0, "higher_highs_higher_lows")]
TREND = [(-3, "strong_down"), (-1, "down"), (1, "neutral"), (3, "up"), (4, "strong_up")]
CYCLE_LINE = [(-0.5, "below"), (0.5, "neutral"), (1.0, "above")]
RSI = [(30, "oversold"), (50, "below_mid"), (70, "above_mid"), (100, "overbought")]
BOLLINGER = [(-0.5, "above_upper"), (0.5, "neutral"), (1.0, "below_lower")]
FUNDING = [(-0.0003, "very_negative"), (-0.0001, "slightly_negative"), (0.0001, "neutral"),
           (0.0003, "slightly_positive"), (1.0, "very_positive")]
FEAR_GREED = [(20, "extreme_fear"), (40, "fear"), (60, "neutral"), (80, "greed"), (100, "extreme_greed")]
DISCLAIMER = "Decision-support only. Not financial advice. Validate manually before trading."


def shown(x: Column) -> Column:
    """A number as text with eight decimals, or ``unavailable``."""
    return F.when(x.isNull(), UNAVAILABLE).otherwise(F.format_string("%.8f", rnd(x, 8)))


def _sign_state(x: Column, above: str, below: str) -> Column:
    return F.when(x > 0, above).when(x < 0, below).otherwise(UNAVAILABLE)


def trade_checklist(df: DataFrame) -> Column:
    """The 27-field trade checklist as one struct column; absent columns count as missing."""
    get = lambda c: F.col(c) if c in df.columns else F.lit(None).cast("double")
    governor = get("funding_oi_governor_risk")
    fields = {
        "market_structure_score": shown(get("market_structure_score")),
        "structure_state": classify(get("market_structure_score"), STRUCTURE),
        "trend_direction": classify(get("ema_stack_score"), TREND),
        "ema_stack_score": shown(get("ema_stack_score")),
        "ema_120_cycle": classify(get("ema_120_cycle_signal"), CYCLE_LINE),
        "rsi_14": shown(get("rsi_14")),
        "rsi_state": classify(get("rsi_14"), RSI),
        "macd_hist": shown(get("macd_hist")),
        "macd_state": _sign_state(get("macd_hist"), "bullish_histogram_rising", "bearish_histogram_falling"),
        "bollinger_state": classify(get("bb_mean_reversion_signal"), BOLLINGER),
        "funding_rate": shown(get("funding_rate")),
        "funding_state": classify(get("funding_rate"), FUNDING),
        "open_interest_change_pct": shown(get("open_interest_change_pct")),
        "funding_oi_governor": F.when(governor == 1.0, "elevated").when(governor == 0.0, "normal").otherwise(UNAVAILABLE),
        "taker_delta_proxy": shown(get("taker_delta_proxy")),
        "cvd_proxy": shown(get("cvd_proxy")),
        "basis_futures_vs_spot": shown(get("basis_futures_vs_spot")),
        "long_short_ratio": shown(get("deriv_global_long_short_ratio")),
        "fear_greed": shown(get("fear_greed")),
        "fear_greed_state": classify(get("fear_greed"), FEAR_GREED),
        "btc_dominance": shown(get("btc_dominance_pct")),
        "atr": shown(get("atr")),
        "atr_pct": shown(get("atr_pct")),
        "current_price": shown(get("close")),
        "min_rr_target": F.lit(2.0),
        "max_risk_per_trade_pct": F.lit(1.0),
        "max_daily_loss_pct": F.lit(4.0),
    }
    return F.struct(*[v.alias(k) for k, v in fields.items()])


def buy_checklist(df: DataFrame) -> Column:
    get = lambda c: F.col(c) if c in df.columns else F.lit(None).cast("double")
    fg = get("fear_greed")
    fields = {
        "current_price": shown(get("close")),
        "distance_from_ath_pct": shown(get("distance_from_ath_pct")),
        "ema_120_cycle_state": classify(get("ema_120_cycle_signal"), CYCLE_LINE),
        "sma_50": shown(get("sma_50")),
        "sma_200": shown(get("sma_200")),
        "rsi_14": shown(get("rsi_14")),
        "macd_hist": shown(get("macd_hist")),
        "trend_direction": classify(get("ema_stack_score"), TREND),
        "fear_greed": shown(fg),
        "btc_active_addresses": shown(get("btc_active_addresses")),
        "btc_hash_rate": shown(get("btc_hash_rate")),
        "btc_miner_revenue_usd": shown(get("btc_miner_revenue_usd")),
        "dca_suggested": F.when(fg > 60, "true").when(fg.isNotNull(), "false").otherwise(UNAVAILABLE),
        "risk_disclaimer": F.lit(DISCLAIMER),
    }
    return F.struct(*[v.alias(k) for k, v in fields.items()])


def latest_scorecard(matrix: DataFrame, keys) -> DataFrame:
    """Both checklists for the newest bar of every series."""
    last = latest(matrix, keys)
    return last.select(*keys, "ts", trade_checklist(last).alias("trade_checklist"),
                       buy_checklist(last).alias("buy_checklist"))
