"""Features from context feeds joined as-of: derivatives, on-chain, sentiment, macro, dominance."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from seriesmill.functions.scalar import TIE, flag, last_anchor, months_since, safe_div
from seriesmill.keys import ANCHOR_DATES
from seriesmill.operators.asof import asof_columns
from seriesmill.plans.blocks import Feature, Layout, Rolling, RunStep, Running, lag, pct_change

# The columns each feed contributes.
DERIVATIVE_COLUMNS = {
    "funding_rate": ["funding_rate"],
    "open_interest_hist": ["open_interest", "open_interest_usd"],
    "global_long_short_ratio": ["global_long_account_pct", "global_short_account_pct", "global_long_short_ratio"],
    "top_trader_position_ratio": ["top_long_position_pct", "top_short_position_pct", "top_long_short_ratio"],
    "taker_long_short_volume": ["taker_buy_volume", "taker_sell_volume", "taker_buy_sell_ratio"],
}
ONCHAIN_BTC = (
    "btc_active_addresses", "btc_hash_rate", "btc_difficulty", "btc_miner_revenue_usd",
    "btc_n_transactions", "btc_supply", "btc_tx_fees_usd",
)
ONCHAIN_ETH = ("eth_supply", "eth_burnt_fees", "gas_safe_gwei", "gas_propose_gwei", "gas_fast_gwei")
MACRO = ("sp500_close", "nasdaq_close", "dxy_close", "vix_close", "fed_funds_rate_pct", "cpi_all_urban")
MACRO_RETURNS = ("sp500_close", "nasdaq_close", "dxy_close", "vix_close")
DOMINANCE = ("btc_dominance_pct", "eth_dominance_pct", "total_market_cap_usd", "total_volume_usd_24h")
FUNDING_LIMIT = 0.0003


def join_derivatives(bars: DataFrame, feeds: Mapping[str, DataFrame], **options) -> DataFrame:
    """As-of join of the derivative feeds; a feed not given leaves its columns NULL."""
    on = tuple(options.get("on", ()))
    wanted = {k: feeds[k].select(*on, "ts", *DERIVATIVE_COLUMNS[k]) for k in DERIVATIVE_COLUMNS if k in feeds}
    joined = asof_columns(bars, wanted, prefix="deriv_", **options) if wanted else bars
    absent = [c for k, cols in DERIVATIVE_COLUMNS.items() if k not in feeds for c in cols]
    return joined.withColumns({f"deriv_{c}": F.lit(None).cast("double") for c in absent})


def join_series(bars: DataFrame, feeds: Mapping[str, DataFrame], names, prefix: str = "", **options) -> DataFrame:
    """As-of join of single-value feeds ``(ts, value)``, one column per name, in one exchange."""
    on = tuple(options.get("on", ()))
    wanted = {n: feeds[n].select(*on, "ts", F.col("value").alias(f"{prefix}{n}")) for n in names if n in feeds}
    joined = asof_columns(bars, wanted, **options) if wanted else bars
    return joined.withColumns({f"{prefix}{n}": F.lit(None).cast("double") for n in names if n not in feeds})


def _funding(L: Layout) -> dict[str, Column]:
    rate = "deriv_funding_rate"
    return {
        "funding_rate": F.col(rate),
        "funding_rate_zscore_50": Rolling(L, 50).zscore(rate),
        "funding_extreme_high": flag(F.col(rate) > FUNDING_LIMIT),
        "funding_extreme_low": flag(F.col(rate) < -FUNDING_LIMIT),
        "funding_rate_8h_delta": F.col(rate) - lag(L, rate),
    }


def _open_interest(L: Layout) -> dict[str, Column]:
    oi = "deriv_open_interest"
    return {
        "open_interest": F.col(oi),
        "open_interest_change_pct": pct_change(L, oi),
        "open_interest_zscore_50": Rolling(L, 50).zscore(oi),
    }


def _quadrants(L: Layout) -> dict[str, Column]:
    move, oi = pct_change(L, "close"), pct_change(L, "deriv_open_interest")
    return {
        "price_up_oi_up": flag((move > 0) & (oi > 0)),
        "price_up_oi_down": flag((move > 0) & (oi < 0)),
        "price_down_oi_up": flag((move < 0) & (oi > 0)),
        "price_down_oi_down": flag((move < 0) & (oi < 0)),
    }


def _taker_delta(df: DataFrame, L: Layout) -> DataFrame:
    buy, sell = F.col("deriv_taker_buy_volume"), F.col("deriv_taker_sell_volume")
    return df.withColumns({"taker_delta_proxy": buy - sell, "taker_imbalance": safe_div(buy - sell, buy + sell)})


add_taker = RunStep(
    _taker_delta, {"_cvd": Running("sum", "taker_delta_proxy")},
    lambda df, L: df.withColumn("cvd_proxy", F.when(F.col("taker_delta_proxy").isNotNull(), F.col("_cvd"))).drop("_cvd"))


add_long_short = Feature(lambda L: {
    "global_long_short_zscore_50": Rolling(L, 50).zscore("deriv_global_long_short_ratio")})


def _governor(_: Layout) -> dict[str, Column]:
    extreme = F.coalesce(F.col("funding_extreme_high"), F.lit(0.0)) + F.coalesce(F.col("funding_extreme_low"), F.lit(0.0))
    crowded = F.abs(F.coalesce(F.col("open_interest_zscore_50"), F.lit(0.0))) > 2.0 + TIE
    return {"funding_oi_governor_risk": flag((extreme > 0) | crowded)}


def basis(spot: str = "spot_close") -> Feature:
    return Feature(lambda L: {"basis_futures_vs_spot": safe_div(F.col("close") - F.col(spot), F.col(spot))})


def onchain(metrics=ONCHAIN_BTC) -> Feature:
    return Feature(lambda L: {k: v for m in metrics for k, v in (
        (f"{m}_zscore_30", Rolling(L, 30).zscore(m)), (f"{m}_delta", F.col(m) - lag(L, m)))})


def _sentiment(L: Layout) -> dict[str, Column]:
    fg = F.col("fear_greed")
    return {
        "fear_greed_zscore_30": Rolling(L, 30).zscore("fear_greed"),
        "fear_greed_delta": fg - lag(L, "fear_greed"),
        "fear_greed_extreme_fear": flag(fg < 20),
        "fear_greed_extreme_greed": flag(fg > 80),
    }


def cycle_months(anchors=ANCHOR_DATES) -> Feature:
    return Feature(lambda L: {"cycle_months_since_halving": months_since(F.col("ts"), last_anchor(F.col("ts"), anchors))})


add_funding = Feature(_funding)
add_open_interest = Feature(_open_interest)
add_price_oi_quadrants = Feature(_quadrants)
add_governor = Feature(derived=_governor)
add_basis = basis()
add_onchain = onchain()
add_sentiment = Feature(_sentiment)
add_macro_returns = Feature(lambda L: {f"macro_{m}_ret": pct_change(L, f"macro_{m}") for m in MACRO_RETURNS})
add_cycle_months = cycle_months()
