"""Forward-looking labels: direction, regime, cycle and trade quality."""

from __future__ import annotations

from collections.abc import Mapping
from itertools import chain

from pyspark.sql import Column, DataFrame, functions as F

from seriesmill.functions.scalar import flag, last_anchor, months_since, safe_div
from seriesmill.keys import ANCHOR_DATES, BARRIER_PARAMS
from seriesmill.operators import indicators as ind
from seriesmill.plans.blocks import (
    POS, TOTAL, Layout, Running, from_blocks, pct_change, to_blocks, with_long_rolling, with_running,
)
from seriesmill.plans.materialize import settle, sized
from seriesmill.plans.passage import Band, with_passage
from seriesmill.plans.quantiles import quantile_table, unpivot

LONG_MEAN_BARS = 1400
#: Rows of a block: what is copied into one is at most a quarter of it.
BLOCK_ROWS = 16_384
COST_PER_ROUND_TRIP = 2 * (4.0 + 5.0) / 10_000.0


def barrier_params(timeframe: Column, table: Mapping[str, tuple[float, int]] = BARRIER_PARAMS) -> tuple[Column, Column]:
    """(ATR multiple, horizon in bars) of a timeframe, from a literal map."""
    lookup = lambda i: F.try_element_at(
        F.create_map(*chain.from_iterable((F.lit(k), F.lit(v[i])) for k, v in table.items())), timeframe)
    return lookup(0), lookup(1)


def horizon(L: Layout, bars: int, *more: str) -> Column:
    """The next ``bars`` bars in order (with ``more`` columns), shorter at the end of the series."""
    return F.collect_list(F.struct("high", "low", "close", *more)).over(L.frame(1, bars))


def add_direction(df: DataFrame, L: Layout, multiple: Column | float, ahead: Column | int, max_ahead: int,
                  atr: str = "atr") -> DataFrame:
    """First barrier hit within the horizon: 2 up, 0 down, 1 neither, -1 both or no ATR.

    ``max_ahead`` is what the layout's copies must reach.
    """
    if L.after < max_ahead:
        raise ValueError("the layout does not reach the horizon")
    width = F.lit(multiple) * F.col(atr) if not isinstance(multiple, Column) else multiple * F.col(atr)
    df = with_passage(df.withColumn("_w", width), L, {"_b": Band(F.col("close") + F.col("_w"), F.col("close") - F.col("_w"), ahead)})
    usable = F.coalesce((F.col(atr) > 0) & (F.col("_b_seen") > 0), F.lit(False))
    found, both, rises = F.col("_b_at") > 0, F.col("_b_up") & F.col("_b_down"), F.col("_b_up")
    df = df.withColumns({
        "direction": F.when(~usable, -1).when(~found, 1).when(both, -1).when(rises, 2).otherwise(0).cast("tinyint"),
        "barrier_hit_offset": F.when(usable, F.when(found, F.col("_b_at")).otherwise(F.col("_b_seen"))).cast("double"),
        "barrier_rr": F.when(usable, F.when(~found, safe_div(F.col("_b_last") - F.col("close"), F.col("_w")))
                             .when(both, 0.0).when(rises, 1.0).otherwise(-1.0)),
    })
    return df.drop("_w", *[f"_b_{c}" for c in ("at", "up", "down", "seen", "last")])


def add_trade_quality(df: DataFrame, L: Layout, ahead: Column | int, max_ahead: int, atr: str = "atr",
                      target_rr: float = 2.0, cost: float = COST_PER_ROUND_TRIP) -> DataFrame:
    """1 when the direction's target is reached before the 1-ATR stop, and pays after costs."""
    if L.after < max_ahead:
        raise ValueError("the layout does not reach the horizon")
    unit, entry = F.col(atr), F.col("close")
    df = df.withColumn("_side", F.when(F.col("direction") == 2, 1).when(F.col("direction") == 0, -1))
    s = F.col("_side")
    stop, target = entry - s * unit, entry + s * target_rr * unit
    df = with_passage(df, L, {"_q": Band(F.greatest(stop, target), F.least(stop, target), ahead)})
    # the first bar that hits anything hits the target and not the stop
    goal, out = F.when(s > 0, F.col("_q_up")).otherwise(F.col("_q_down")), F.when(s > 0, F.col("_q_down")).otherwise(F.col("_q_up"))
    pays = target_rr - safe_div(cost * entry, unit) > 0
    good = s.isNotNull() & (unit > 0) & (F.col("_q_at") > 0) & goal & ~out & pays
    return df.withColumn("trade_quality", flag(good).cast("tinyint")).drop("_side", *[f"_q_{c}" for c in ("at", "up", "down", "seen", "last")])


def quality_from_outcome(direction: Column, rr: Column, cost: float = COST_PER_ROUND_TRIP) -> Column:
    """Trade quality without bars: a directional hit whose size exceeds the costs."""
    return flag(direction.isin(0, 2) & (F.abs(rr) - cost > 0)).cast("tinyint")


def regime_inputs(bars: DataFrame, layout: Layout) -> DataFrame:
    """What the regime rules read, one row per bar."""
    steps = [ind.add_ema, ind.add_ema_state, ind.add_true_range, ind.add_atr,
             ind.volatility((20,)),
             lambda d, L: d.withColumns({"_slope": pct_change(L, "ema_50", 10), "_ret": pct_change(L, "close")})]
    df = ind.on_bars(bars, layout.cut(BLOCK_ROWS), *steps, before=ind.EMA_LOOKBACK)
    return df.select(*layout.keys, layout.ts, "ema_stack_score", "_slope", "_ret", "atr_pct",
                     F.col("realized_volatility_20").alias("_rv"))


def regime_labels(bars: DataFrame, layout: Layout, fit_on: Column | None = None) -> DataFrame:
    """Six regimes from averages, volatility and ATR against the series' own quantiles.

    ``fit_on`` restricts the rows the quantiles are taken from (e.g. a training fold).
    """
    keys = list(layout.keys)
    base = settle(regime_inputs(bars, layout))
    fit = base.where(fit_on) if fit_on is not None else base
    table = quantile_table(unpivot(fit, keys, ["_rv", "atr_pct"]), [*keys, "feature"], "value",
                           {"q33": 0.33, "q66": 0.66, "q85": 0.85})
    pick = lambda f, q: F.max(F.when(F.col("feature") == f, F.col(q)))
    limits = table.groupBy(*keys).agg(pick("_rv", "q33").alias("_rv_lo"), pick("_rv", "q66").alias("_rv_hi"),
                                      pick("atr_pct", "q85").alias("_atr_hi"))
    df = base.join(sized(limits), keys, "left")
    stack, slope, rv = F.col("ema_stack_score"), F.col("_slope"), F.col("_rv")
    label = (
        F.when((F.col("_ret") < -0.10) & (rv > F.col("_rv_hi")), "capitulation")
        .when((F.col("atr_pct") > F.col("_atr_hi")) & (F.abs(stack) >= 2), "breakout")
        .when((rv > F.col("_rv_hi")) & (F.abs(stack) < 2), "ranging_high_vol")
        .when((rv <= F.col("_rv_lo")) & (F.abs(stack) < 2), "ranging_low_vol")
        .when((stack <= -2) & (slope < 0), "trending_down")
        .when((stack >= 2) & (slope > 0), "trending_up")
        .otherwise("ranging_low_vol"))
    return df.select(*keys, layout.ts, label.alias("regime"))


def add_cycle(df: DataFrame, L: Layout, anchors=ANCHOR_DATES, long_bars: int = LONG_MEAN_BARS) -> DataFrame:
    """Four cycle phases from months since the anchor, drawdown and the long mean.

    A series no longer than ``long_bars`` uses an exponential mean over its own length
    instead; its weights stay within e^2, so a running weighted sum is exact.
    """
    short = F.col(TOTAL) <= long_bars
    q = 1 - 2.0 / (F.col(TOTAL) + 1)
    step = F.col(POS).cast("double")
    df = df.withColumns({"_q": q, "_scaled": F.when(short, F.col("close") * F.pow(q, -step))})
    df = with_running(df, L, {"_peak": Running("max", "close"), "_acc": Running("sum", "_scaled")})
    df = with_long_rolling(df, L, {"_long": ("mean", "close", long_bars)})
    weight = safe_div(1 - F.pow(F.col("_q"), step + 1), 1 - F.col("_q"))
    mean = F.when(short, F.when(F.col(TOTAL) == 1, F.col("close")).otherwise(
        safe_div(F.col("_acc") * F.pow(F.col("_q"), step), weight))).otherwise(F.col("_long"))
    ts = F.col(L.ts)
    df = df.withColumns({"_months": months_since(ts, last_anchor(ts, anchors)),
                         "_dd": safe_div(F.col("close"), F.col("_peak")) - 1,
                         "_above": F.coalesce(F.col("close") > mean, F.lit(False))})
    months, dd, above = F.col("_months"), F.col("_dd"), F.col("_above")
    label = (
        F.when((dd < -0.5) | ((months > 30) & ~above), "accumulation")
        .when((dd < -0.4) & ~above, "bear")
        .when((months >= 14) & (months <= 24) & (dd > -0.2) & above, "distribution")
        .when((months > 4) & (months < 22) & (dd > -0.3) & above, "bull")
        .otherwise("accumulation"))
    return df.withColumn("cycle", label).drop(
        "_q", "_scaled", "_peak", "_acc", "_long", "_months", "_dd", "_above")


def label_bars(bars: DataFrame, layout: Layout, params: Mapping[str, tuple[float, int]] = BARRIER_PARAMS,
               anchors=ANCHOR_DATES, with_regime: bool = True) -> DataFrame:
    """All labels per bar; horizons and barrier widths come from the timeframe."""
    ahead_max = max(n for _, n in params.values())
    k, n = barrier_params(F.col("timeframe"), params)
    L = layout.cut(BLOCK_ROWS).reach(before=max(ind.ATR_LOOKBACK, LONG_MEAN_BARS), after=2 * ahead_max)
    df = to_blocks(bars, L)
    df = add_cycle(df, L, anchors)
    df = ind.add_atr(ind.add_true_range(df, L), L)
    df = add_direction(df, L, k, n, ahead_max)
    df = add_trade_quality(df, L, n * 2, 2 * ahead_max)
    out = from_blocks(df).select(*layout.keys, layout.ts, "direction", "barrier_hit_offset", "barrier_rr",
                                 "cycle", "trade_quality")
    if not with_regime:
        return out
    return out.join(regime_labels(bars, layout), [*layout.keys, layout.ts])


def label_summary(labels: DataFrame, keys) -> DataFrame:
    """Class counts per series and its three most frequent regimes."""
    keys = list(keys)
    counts = labels.groupBy(*keys, "regime").agg(
        F.count(F.lit(1)).alias("n"),
        *[F.sum(F.when(F.col("direction") == v, 1).otherwise(0)).alias(name)
          for name, v in (("dir_up", 2), ("dir_down", 0), ("dir_sideways", 1), ("dir_ambiguous", -1))],
        F.sum(F.col("trade_quality").cast("bigint")).alias("tq_good"))
    # at most one row per regime is left, so the list below has six entries at most
    ranked = F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("k"), "regime")))
    return counts.groupBy(*keys).agg(
        F.sum("n").alias("rows"), *[F.sum(c).alias(c) for c in ("dir_up", "dir_down", "dir_sideways", "dir_ambiguous", "tq_good")],
        F.array_join(F.transform(F.slice(ranked, 1, 3), lambda r: r["regime"]), ",").alias("top_regimes"))
