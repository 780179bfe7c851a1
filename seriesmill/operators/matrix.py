"""The feature matrix: every feature block on one block layout."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from seriesmill.keys import ANCHOR_DATES, OHLCV, SERIES_KEYS
from seriesmill.operators import context as ctx, indicators as ind, patterns as pat, structure as stc
from seriesmill.operators.asof import asof_columns
from seriesmill.plans.blocks import HELPERS, POS, TOTAL, Layout, apply_features, feature_names, from_blocks, lay_out, run_together, to_blocks
from seriesmill.plans.materialize import settle

FLOW = tuple(f"deriv_{c}" for cols in ctx.DERIVATIVE_COLUMNS.values() for c in cols)
MATRIX_LOOKBACK = ind.EMA_LOOKBACK
#: Rows of a block: a year's look-back is copied into blocks of few columns, the many columns look back over some windows only.
DEEP_ROWS, WIDE_ROWS, WIDE_LOOKBACK = 32_768, 8_192, 256
# what looks back far reads prices only
_DEEP = (ind.add_ema, ind.add_ema_state, ind.add_rsi, ind.add_rsi_state, ind.add_macd, ind.add_true_range, ind.add_atr)


def first_occurrences(columns: Sequence[str]) -> list[str]:
    """Names in order, later duplicates left out."""
    return list(dict.fromkeys(columns))


def join_context(bars: DataFrame, feeds: Mapping[str, DataFrame], spot: DataFrame | None = None,
                 **options) -> DataFrame:
    """All context columns (fixed schema, NULL where a feed is absent) in one union per scope.

    ``feeds`` maps feed names to ``(ts, value...)`` frames; ``spot`` is the spot bar table
    the basis of futures bars refers to.
    """
    wanted: dict[str, DataFrame] = {}
    for name, cols in ctx.DERIVATIVE_COLUMNS.items():
        if name in feeds:
            wanted[name] = feeds[name].select("ts", *[F.col(c).alias(f"deriv_{c}") for c in cols])
    singles = {**{m: m for m in ctx.ONCHAIN_BTC + ctx.ONCHAIN_ETH}, "fear_greed": "fear_greed",
               **{m: f"macro_{m}" for m in ctx.MACRO}, **{c: c for c in ctx.DOMINANCE}}
    for name, target in singles.items():
        if name in feeds:
            wanted[name] = feeds[name].select("ts", F.col("value").cast("double").alias(target))
    joined = asof_columns(bars, wanted, **options) if wanted else bars
    have = set(joined.columns)
    missing = [c for c in (*FLOW, *singles.values()) if c not in have]
    joined = joined.withColumns({c: F.lit(None).cast("double") for c in missing})
    if spot is None:
        # on a spot series the basis refers to the series itself
        return joined.withColumn("spot_close", F.col("close"))
    right = spot.select("symbol", "timeframe", "ts", F.col("close").alias("spot_close"))
    return asof_columns(joined, {"spot": right}, on=("symbol", "timeframe"),
                        **{k: v for k, v in options.items() if k in ("bucket_ms", "grid_ms")})


def feature_matrix(bars: DataFrame, layout: Layout, feeds: Mapping[str, DataFrame] | None = None,
                   spot: DataFrame | None = None, anchors=ANCHOR_DATES, year_windows=None,
                   **asof_options) -> DataFrame:
    """Keys, ``ts``, OHLCV and about 130 causal feature columns, one row per bar.

    Running aggregates come first, on the narrow frame, because each reads its input
    twice; the blocks are then written once.  What looks back far (year extremes, smoothing
    averages) is computed on the prices alone; the wide rest looks back over
    ``WIDE_LOOKBACK`` rows and has smaller blocks, so one series keeps many tasks busy.
    """
    ind.require_columns(bars, (*layout.keys, layout.ts, *OHLCV))
    windows = ind.YEAR_WINDOWS if year_windows is None else year_windows
    L = layout.cut(DEEP_ROWS).reach(before=max([MATRIX_LOOKBACK, *windows.values()]))
    W = layout.cut(WIDE_ROWS).reach(before=WIDE_LOOKBACK)
    joined = join_context(bars, feeds or {}, spot, **{"grid_ms": layout.step_ms, **asof_options})
    if feeds or spot is not None:
        joined = settle(joined)
    df = to_blocks(joined, L)
    df = run_together(df, L, [ind.add_obv, ind.add_extremes, stc.add_swings, stc.add_character_change, ctx.add_taker])
    df = settle(stc.add_structure_score(df, L))
    at = [*layout.keys, POS]
    prices = df.select(*layout.keys, layout.ts, *OHLCV, *HELPERS)
    deep = from_blocks(apply_features(ind.add_year_extremes(prices, L, windows), L, _DEEP), keep_position=True).drop(
        layout.ts, *OHLCV, TOTAL)
    rows = from_blocks(df, keep_position=True)
    features = [
        ind.add_returns, ind.add_ema, ind.add_ema_state, ind.add_sma, ind.add_rsi, ind.add_rsi_state, ind.add_macd,
        ind.add_bollinger, ind.add_true_range, ind.add_atr, ind.add_volume, ind.add_vwap, ind.add_volatility,
        stc.range_breakout(20), stc.range_breakout(50), stc.add_gaps, stc.add_order_blocks,
        pat.add_anatomy, pat.add_single_bar_patterns, pat.add_two_bar_patterns,
        ctx.add_sentiment, ctx.add_onchain, ctx.add_macro_returns, ctx.cycle_months(anchors),
        ctx.add_funding, ctx.add_open_interest, ctx.add_price_oi_quadrants, ctx.add_long_short, ctx.add_governor,
        ctx.add_basis,
    ]
    wide = apply_features(lay_out(rows.join(deep, at), W), W, [f for f in features if f not in _DEEP])
    added = feature_names(W, features)
    first = first_occurrences([*rows.columns, *[c for c in deep.columns if c not in added]])
    return from_blocks(wide.select(*[c for c in first if c not in HELPERS], *added, *HELPERS)).drop("spot_close")


def feature_columns(df: DataFrame, keys=SERIES_KEYS) -> list[str]:
    """Numeric feature columns of a matrix, in order."""
    numeric = {"double", "float", "bigint", "int", "smallint", "tinyint"}
    return [f.name for f in df.schema.fields if f.name not in (*keys, "ts") and f.dataType.simpleString() in numeric]
