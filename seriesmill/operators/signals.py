"""Signals from class probabilities and from rules; every strategy is a Column struct."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from seriesmill.functions.scalar import col
from seriesmill.plans.materialize import with_scalars

THRESHOLD, QUALITY = 0.58, 0.60
# The threshold grid.
GRID = (0.40, 0.45, 0.50, 0.55, 0.58, 0.60, 0.65, 0.70)


def signal(side: Column, confidence: Column, reason: Column) -> Column:
    return F.struct(side.cast("int").alias("side"), confidence.cast("double").alias("confidence"),
                    reason.alias("reason"))


def _choose(cases, default) -> Column:
    """First matching (condition, side, confidence, reason)."""
    lit = lambda v: v if isinstance(v, Column) else F.lit(v)
    out = None
    for condition, *value in cases:
        made = signal(*[lit(v) for v in value])
        out = F.when(condition, made) if out is None else out.when(condition, made)
    made = signal(*[lit(v) for v in default])
    return made if out is None else out.otherwise(made)


def model_signal(down="p_down", sideways="p_sideways", up="p_up", quality="quality", long_at: float = THRESHOLD,
                 short_at: float = THRESHOLD, trade_at: float = THRESHOLD, quality_at: float = QUALITY) -> Column:
    d, s, u, q = col(down), col(sideways), col(up), col(quality)
    top = F.greatest(d, s, u)
    return _choose([
        (top < trade_at, 0, top, "confidence below no_trade threshold"),
        ((u >= long_at) & (q >= quality_at), 1, u, "long_bias"),
        ((d >= short_at) & (q >= quality_at), -1, d, "short_bias"),
    ], (0, top, "quality threshold not met"))


def hedged_signal(high_risk: Column, down="p_down", sideways="p_sideways", up="p_up", quality="quality",
                  long_at: float = THRESHOLD, short_at: float = THRESHOLD, trade_at: float = THRESHOLD) -> Column:
    """(action, reason) in the hedged vocabulary; risk flags come first."""
    d, s, u, q = col(down), col(sideways), col(up), col(quality)
    top = F.greatest(d, s, u)
    rules = [
        (F.coalesce(high_risk, F.lit(False)), "high_risk", "funding/OI governor flagged elevated squeeze risk"),
        (top < trade_at, "no_trade", "confidence below configured threshold"),
        (s == top, "range_wait", "model favours sideways/range"),
        ((u >= long_at) & (q >= QUALITY), "long_bias", "up probability and trade-quality above thresholds"),
        ((d >= short_at) & (q >= QUALITY), "short_bias", "down probability and trade-quality above thresholds"),
    ]
    out = None
    for condition, action, reason in rules:
        made = F.struct(F.lit(action).alias("action"), F.lit(reason).alias("reason"))
        out = F.when(condition, made) if out is None else out.when(condition, made)
    return out.otherwise(F.struct(F.lit("no_trade").alias("action"), F.lit("trade-quality below threshold").alias("reason")))


def top_class(down="p_down", sideways="p_sideways", up="p_up") -> Column:
    """Index of the largest probability, the first on ties."""
    p = F.array(col(down), col(sideways), col(up))
    return (F.array_position(p, F.array_max(p)) - 1).cast("int")


def threshold_class(long_at: float, short_at: float, trade_at: float) -> Column:
    """Predicted class, -1 for no trade."""
    top, c = F.greatest("p_down", "p_sideways", "p_up"), top_class()
    return (F.when((top >= trade_at) & (c == 2) & (F.col("p_up") >= long_at), 2)
            .when((top >= trade_at) & (c == 0) & (F.col("p_down") >= short_at), 0)
            .when((top >= trade_at) & (c == 1), 1).otherwise(-1))


def tune_thresholds(df: DataFrame, label: str = "y", min_precision: float = 0.45, grid=GRID) -> DataFrame:
    """Best (long, short, no-trade) thresholds by macro F1 over the covered rows.

    A row matters only through its top class and the grid step its top probability
    reaches, so one aggregation leaves at most classes x steps x labels rows; the grid is
    then evaluated on that table, not on the data.
    """
    spark = df.sparkSession
    steps = sorted(grid)
    top = F.greatest("p_down", "p_sideways", "p_up")
    level = F.size(F.filter(F.array(*[F.lit(float(g)) for g in steps]), lambda g: g <= top))
    summary = df.groupBy(top_class().alias("c"), level.alias("level"), F.col(label).cast("int").alias("y")).agg(
        F.count(F.lit(1)).alias("n"))
    combos = [(i, steps[a], steps[b], steps[c], a, b, c) for i, (a, b, c) in enumerate(
        (a, b, c) for a in range(len(steps)) for b in range(a, len(steps)) for c in range(a, len(steps)))]
    table = spark.createDataFrame(combos, "grid_order int, no_trade double, long double, short double, a int, b int, c0 int")
    needed = F.when(F.col("c") == 2, F.col("b")).when(F.col("c") == 0, F.col("c0")).otherwise(F.col("a"))
    # covered rows of each combination: summary rows whose level reaches the class's step
    counted = table.join(F.broadcast(summary), F.col("level") > needed, "left")
    at = ["grid_order", "no_trade", "long", "short"]
    n_if = lambda cond: F.coalesce(F.sum(F.when(cond, F.col("n"))), F.lit(0))
    measures = [n_if(F.lit(True)).alias("covered"), F.countDistinct("c").alias("classes")]
    for k in range(3):
        measures += [n_if((F.col("c") == k) & (F.col("y") == k)).alias(f"tp{k}"),
                     n_if((F.col("c") == k) & (F.col("y") != k)).alias(f"fp{k}"),
                     n_if((F.col("c") != k) & (F.col("y") == k)).alias(f"fn{k}")]
    scored = counted.groupBy(*at).agg(*measures)
    total = summary.agg(F.sum("n").alias("total"))
    ratio = lambda a, b: F.coalesce(F.try_divide(a.cast("double"), b), F.lit(0.0))
    f1, seen = F.lit(0.0), F.lit(0)
    for k in range(3):
        tp, fp, fn = (F.col(f"{m}{k}") for m in ("tp", "fp", "fn"))
        f1 = f1 + ratio(2 * tp, 2 * tp + fp + fn)
        seen = seen + F.when(tp + fp + fn > 0, 1).otherwise(0)
    scored = with_scalars(scored, total).withColumns({
        "macro_f1": ratio(f1, seen),
        "long_precision": ratio(F.col("tp2"), F.col("tp2") + F.col("fp2")),
        "short_precision": ratio(F.col("tp0"), F.col("tp0") + F.col("fp0")),
        "coverage_pct": F.col("covered") * 100.0 / F.col("total"),
    })
    enough = F.greatest(F.lit(20), F.floor(F.col("total") / 20))
    ok = scored.where((F.col("covered") >= enough) & (F.col("classes") >= 2)
                      & (F.least("long_precision", "short_precision") >= min_precision))
    best = ok.orderBy(F.round("macro_f1", 12).desc(), "grid_order").limit(1).select(
        F.col("long").alias("long_threshold"), F.col("short").alias("short_threshold"),
        F.col("no_trade").alias("no_trade_threshold"), "macro_f1", "coverage_pct", F.lit(0).alias("_rank"))
    fallback = spark.range(1).select(*[F.lit(THRESHOLD).alias(f"{k}_threshold") for k in ("long", "short", "no_trade")],
                                     F.lit(0.0).alias("macro_f1"), F.lit(0.0).alias("coverage_pct"), F.lit(1).alias("_rank"))
    return best.unionByName(fallback).orderBy("_rank").limit(1).drop("_rank")


def buy_and_hold(position: str = "_pos") -> Column:
    return _choose([(F.col(position) == 0, 1, 1.0, "buy_and_hold initial entry")], (0, 0.0, "buy_and_hold hold"))


def majority_class() -> Column:
    return _choose([], (0, 0.0, "majority_class baseline never trades"))


def no_trade() -> Column:
    return _choose([], (0, 0.0, "no_trade baseline"))


def ema_trend() -> Column:
    a, b = F.col("ema_9"), F.col("ema_21")
    return _choose([(a.isNull() | b.isNull(), 0, 0.0, "ema unavailable"), (a > b, 1, 0.6, "ema9 > ema21"),
                    (a < b, -1, 0.6, "ema9 < ema21")], (0, 0.0, "ema flat"))


def rsi_macd() -> Column:
    rsi, hist = F.col("rsi_14"), F.col("macd_hist")
    return _choose([(rsi.isNull() | hist.isNull(), 0, 0.0, "rsi/macd unavailable"),
                    ((rsi < 30) & (hist > 0), 1, 0.6, "rsi oversold + macd bullish"),
                    ((rsi > 70) & (hist < 0), -1, 0.6, "rsi overbought + macd bearish")],
                   (0, 0.0, "no rsi/macd setup"))


def random_choice(*ids: str | Column, seed: int = 42) -> Column:
    """Uniform number in [0, 1) from the row's ids: the first 32 bits of an MD5 of their texts and the seed.

    The same on every run, partitioning and engine.
    """
    text = F.concat_ws("|", *[(F.col(c) if isinstance(c, str) else c).cast("string") for c in ids], F.lit(str(seed)))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("double") / F.lit(float(1 << 32))


def random_signal(*ids: str | Column, seed: int = 42) -> Column:
    u = random_choice(*ids, seed=seed)
    return _choose([(u < 0.33, 1, 0.33, "random long"), (u < 0.66, -1, 0.33, "random short")], (0, 0.34, "random flat"))


