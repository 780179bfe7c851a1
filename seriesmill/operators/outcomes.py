"""What signals would have earned: costs, entry levels, the exit ladder, trade and equity metrics."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from seriesmill.operators.labels import horizon
from seriesmill.plans.blocks import OWN, POS, Layout, Running, from_blocks, lag, to_blocks, with_running
from seriesmill.plans.quantiles import quantile_table

FEE_BPS, MIN_SLIP_BPS, MAX_SLIP_BPS, ATR_FRACTION = 4.0, 2.0, 15.0, 0.02
INITIAL_EQUITY, RISK_PCT, DAILY_LOSS_PCT, STOP_ATR = 10_000.0, 1.0, 4.0, 1.5
TARGETS_R = (1.0, 2.0, 3.0)
SHARES = (0.33, 0.33, 0.34)


def fee(notional: Column, bps: float = FEE_BPS) -> Column:
    return F.abs(notional) * bps / 10_000.0


def slip_bps(atr: Column, price: Column) -> Column:
    raw = F.try_divide(ATR_FRACTION * atr, price) * 10_000.0
    known = (price > 0) & (atr > 0)
    return F.when(known, F.greatest(F.lit(MIN_SLIP_BPS), F.least(F.lit(MAX_SLIP_BPS), raw))).otherwise(MIN_SLIP_BPS)


def slip_price(price: Column, atr: Column, side: Column) -> Column:
    """Worse by the slippage: higher when buying, lower when selling."""
    return price * (1.0 + side * slip_bps(atr, price) / 10_000.0)


def add_entry(df: DataFrame, side: str = "side", price: str = "close", atr: str = "atr") -> DataFrame:
    """Entry, stop, three targets, size for a fixed risk, entry fee and slippage."""
    s, unit = F.col(side), F.col(atr) * STOP_ATR
    df = df.withColumn("entry_price", slip_price(F.col(price), F.col(atr), s))
    entry = F.col("entry_price")
    df = df.withColumns({
        "stop_price": entry - s * unit,
        **{f"tp{k + 1}": entry + s * unit * r for k, r in enumerate(TARGETS_R)},
    })
    df = df.withColumn("size", F.try_divide(F.lit(INITIAL_EQUITY * RISK_PCT / 100.0), F.abs(entry - F.col("stop_price"))))
    return df.withColumns({
        "entry_fee": fee(F.col("size") * entry),
        "entry_slippage": F.abs(entry - F.col(price)) * F.col("size"),
    })


def add_ladder(df: DataFrame, L: Layout, max_holding: int) -> DataFrame:
    """Outcome of an independent trade per row with a non-zero ``side``.

    Stop first, then the targets in order (33/33/34 % closed); the stop moves to entry
    after the first and to the first target after the second; what is left exits at the
    close of the last allowed bar, or of the series.
    """
    return _walked(df.withColumn("_h", horizon(L, max_holding - 1, L.ts)), L, max_holding)


def strategy_trades(df: DataFrame, L: Layout, max_holding: int, sides: Mapping[str, Column]) -> DataFrame:
    """Ladder trades of several strategies, one row per strategy and bar with a side.

    The bars ahead are gathered once per bar; only bars with a side become trades.
    """
    chosen = F.array(*[F.struct(F.lit(k).alias("strategy"), v.cast("int").alias("side")) for k, v in sides.items()])
    df = df.withColumn("_h", horizon(L, max_holding - 1, L.ts)).withColumn("_s", F.explode(F.filter(chosen, lambda s: s["side"] != 0)))
    return _walked(add_entry(df.withColumns({"strategy": F.col("_s.strategy"), "side": F.col("_s.side")}).drop("_s")), L, max_holding)


def _walked(df: DataFrame, L: Layout, max_holding: int) -> DataFrame:
    ahead = max_holding - 1  # the entry bar counts as the first bar held
    trades = (F.col("side") != 0) & (F.col("atr") > 0) & (F.size("_h") > 0) & F.col("size").isNotNull()
    s, entry, atr = F.col("side").cast("double"), F.col("entry_price"), F.col("atr")
    levels = [F.col("tp1"), F.col("tp2"), F.col("tp3")]

    def gain(price: Column, share: Column) -> Column:
        out = slip_price(price, atr, -s)
        return ((out - entry) * s - fee(out)) * share

    def cost(price: Column, share: Column) -> Column:
        return fee(slip_price(price, atr, -s)) * share

    def drag(price: Column, share: Column) -> Column:
        return F.abs(slip_price(price, atr, -s) - price) * share

    def step(a: Column, b: Column) -> Column:
        live = a["reason"].isNull()
        stopped = live & F.when(s > 0, b["low"] <= a["stop"]).otherwise(b["high"] >= a["stop"])
        # a bar that reaches a later target has reached the earlier ones as well
        passed = [live & ~stopped & (a["done"] <= k)
                  & F.when(s > 0, b["high"] >= levels[k]).otherwise(b["low"] <= levels[k]) for k in range(3)]
        share = [F.when(p, F.lit(x)).otherwise(0.0) for p, x in zip(passed, SHARES)]
        left = a["left"] - share[0] - share[1] - share[2]
        expired = live & ~stopped & ~passed[2] & (a["k"] + 1 >= ahead)
        rest = F.when(stopped, a["left"]).when(expired, left).otherwise(0.0)
        at = F.when(stopped, a["stop"]).otherwise(b["close"])
        add = lambda f: sum((f(lv, sh) for lv, sh in zip(levels, share)), f(at, rest))
        final = stopped | passed[2] | expired
        return F.struct(
            (a["k"] + F.when(live, 1).otherwise(0)).alias("k"),
            F.when(stopped | expired, 0.0).otherwise(left).alias("left"),
            F.when(passed[1], levels[0]).when(passed[0] & (a["done"] == 0), entry).otherwise(a["stop"]).alias("stop"),
            F.when(passed[2], 3).when(passed[1], 2).when(passed[0], 1).otherwise(a["done"]).alias("done"),
            (a["pnl"] + add(gain)).alias("pnl"), (a["fees"] + add(cost)).alias("fees"),
            (a["drag"] + add(drag)).alias("drag"),
            F.when(final, F.when(stopped, a["stop"]).when(passed[2], levels[2]).otherwise(b["close"]))
            .otherwise(a["exit"]).alias("exit"),
            F.when(stopped, "stop").when(passed[2], "tp3").when(expired, "vertical_barrier").otherwise(a["reason"]).alias("reason"))

    zero = F.lit(0.0)
    start = F.struct(F.lit(0).alias("k"), F.lit(1.0).alias("left"), F.col("stop_price").alias("stop"), F.lit(0).alias("done"),
                     zero.alias("pnl"), zero.alias("fees"), zero.alias("drag"), F.lit(None).cast("double").alias("exit"),
                     F.lit(None).cast("string").alias("reason"))
    df = df.withColumn("_o", F.when(trades, F.aggregate("_h", start, step)))
    final = F.try_element_at(F.col("_h"), F.lit(-1))["close"]
    still = F.when(F.col("_o.reason").isNull(), F.col("_o.left")).otherwise(0.0)
    size = F.col("size")
    return df.withColumns({
        "bars_held": F.col("_o.k"),
        "close_ts": F.when(F.col("_o.k") > 0, F.try_element_at(F.col("_h"), F.col("_o.k"))[L.ts]),
        "exit_reason": F.when(F.col("_o").isNotNull(), F.coalesce("_o.reason", F.lit("end_of_data"))),
        "exit_price": slip_price(F.coalesce("_o.exit", final), atr, -s),
        "realized_pnl": (F.col("_o.pnl") + gain(final, still)) * size,
        "fees_paid": F.col("entry_fee") + (F.col("_o.fees") + cost(final, still)) * size,
        "slippage_cost": F.col("entry_slippage") + (F.col("_o.drag") + drag(final, still)) * size,
    }).withColumn("rr_realized", F.try_divide(F.col("realized_pnl"), F.abs(entry - F.col("stop_price")) * size)).drop("_h", "_o")


def trade_metrics(trades: DataFrame, groups: Sequence[str], total_bars: Column | int = 0, bar_ms: int = 3_600_000,
                  open_ts: str = "ts", close_ts: str = "close_ts") -> DataFrame:
    """Counts, win rates, R statistics, profit factor, costs and exposure per group."""
    groups = list(groups)
    rr, pnl, side = F.col("rr_realized"), F.col("realized_pnl"), F.col("side")
    won = F.when(rr > 0, 1.0).otherwise(0.0)
    seconds = (F.unix_millis(close_ts) - F.unix_millis(open_ts)) / 1000.0
    share = lambda cond: F.coalesce(F.avg(F.when(cond, won)) * 100, F.lit(0.0))
    wins = F.coalesce(F.sum(F.when(pnl > 0, pnl)), F.lit(0.0))
    losses = F.coalesce(-F.sum(F.when(pnl < 0, pnl)), F.lit(0.0))
    base = trades.groupBy(*groups).agg(
        F.count(F.lit(1)).alias("n_trades"), (F.avg(won) * 100).alias("win_rate"), F.avg(rr).alias("avg_r"),
        F.avg(rr).alias("expectancy_r"),
        F.when(losses > 0, F.try_divide(wins, losses)).when(wins > 0, float("inf")).otherwise(0.0).alias("profit_factor"),
        F.avg(seconds).alias("avg_holding_seconds"), F.count(F.when(side == 1, 1)).alias("long_trades"),
        F.count(F.when(side == -1, 1)).alias("short_trades"), share(side == 1).alias("long_win_rate"),
        share(side == -1).alias("short_win_rate"), F.sum("fees_paid").alias("fee_drag_total"),
        F.sum("slippage_cost").alias("slippage_drag_total"),
        (F.sum(seconds) * 1000.0 / bar_ms / F.greatest(F.lit(1.0), F.max(total_bars) if isinstance(total_bars, Column)
                                                       else F.lit(float(total_bars))) * 100).alias("exposure_pct"))
    medians = quantile_table(trades, groups, "rr_realized", {"median_r": 0.5})
    return base.join(medians, groups, "left")


def worst_trades(trades: DataFrame, groups: Sequence[str], n: int = 10, salts: int = 16,
                 ids: Sequence[str] = ("ts",)) -> DataFrame:
    """The ``n`` lowest P&Ls per group: salted first, so a hot group is ranked in parts."""
    salt = F.pmod(F.xxhash64(*[F.col(c) for c in (*groups, *ids)]), F.lit(salts))
    order = [F.col("realized_pnl"), *[F.col(c) for c in ids]]
    part = Window.partitionBy(*groups, "_salt").orderBy(*order)
    whole = Window.partitionBy(*groups).orderBy(*order)
    few = (trades.withColumn("_salt", salt).withColumn("rank", F.row_number().over(part))
           .where(F.col("rank") <= n))
    return few.withColumn("rank", F.row_number().over(whole)).where(F.col("rank") <= n).drop("_salt")


def equity_curve(trades: DataFrame, layout: Layout, initial: float = INITIAL_EQUITY) -> DataFrame:
    """Equity after every exit: initial plus the running P&L in exit order."""
    df = to_blocks(trades, layout)
    df = with_running(df, layout, {"_sum_pnl": Running("sum", "realized_pnl")})
    return from_blocks(df).withColumn("equity", F.col("_sum_pnl") + initial).drop("_sum_pnl")


def equity_metrics(curve: DataFrame, layout: Layout, initial: float = INITIAL_EQUITY) -> DataFrame:
    """Total return, maximum drawdown, Sharpe and Sortino (scaled by the root of the count)."""
    L = layout.reach(before=1)
    df = to_blocks(curve, L)
    df = with_running(df, L, {"_peak": Running("max", "equity")})
    df = df.withColumn("_ret", F.try_divide(F.col("equity"), lag(L, "equity")) - 1).where(F.col(OWN))
    ret = F.col("_ret")
    mean, spread, n = F.avg(ret), F.stddev_pop(ret), F.count(ret)
    down = F.stddev_pop(F.when(ret < 0, ret))
    losing = F.count(F.when(ret < 0, 1))
    root = F.sqrt(n.cast("double"))
    return df.groupBy(*L.keys).agg(
        ((F.max_by("equity", POS) / initial - 1) * 100).alias("total_return_pct"),
        (F.min(F.try_divide(F.col("equity") - F.col("_peak"), F.col("_peak"))) * 100).alias("max_drawdown_pct"),
        F.when((n < 2) | (spread == 0), 0.0).otherwise(F.try_divide(mean, spread) * root).alias("sharpe"),
        F.when(n < 2, 0.0).when(losing == 0, F.when(mean > 0, float("inf")).otherwise(0.0))
        .when(down == 0, F.when(mean > 0, float("inf")).when(mean < 0, float("-inf")))
        .otherwise(F.try_divide(mean, down) * root).alias("sortino"))


def daily_loss_cap(trades: DataFrame, groups: Sequence[str], open_ts: str = "ts", close_ts: str = "close_ts",
                   limit: float = INITIAL_EQUITY * DAILY_LOSS_PCT / 100.0) -> DataFrame:
    """Trades entered before the day's realised losses reach the limit.

    Entries and exits of one series and day meet in one window; a day holds a bounded
    number of bars.
    """
    cols = trades.columns
    day = lambda c: F.date_trunc("day", F.col(c))
    row = F.struct(*cols)
    entries = trades.select(*groups, day(open_ts).alias("_day"), F.col(open_ts).alias("_at"), F.lit(1).alias("_kind"),
                            F.lit(0.0).alias("_loss"), row.alias("_row"))
    exits = trades.select(*groups, day(close_ts).alias("_day"), F.col(close_ts).alias("_at"), F.lit(0).alias("_kind"),
                          F.greatest(-F.col("realized_pnl"), F.lit(0.0)).alias("_loss"), F.lit(None).alias("_row"))
    w = Window.partitionBy(*groups, "_day").orderBy("_at", "_kind").rowsBetween(Window.unboundedPreceding, 0)
    both = entries.unionByName(exits).withColumn("_spent", F.sum("_loss").over(w))
    return both.where((F.col("_kind") == 1) & (F.col("_spent") < limit)).select(*[F.col(f"_row.{c}").alias(c) for c in cols])


def compare_strategies(metrics: DataFrame, groups: Sequence[str], model: str = "model") -> DataFrame:
    """Every strategy's return next to the best baseline, with the verdict on the model."""
    per = Window.partitionBy(*groups)  # one row per strategy
    best = F.max(F.when(F.col("strategy") != model, F.col("total_return_pct"))).over(per)
    own = F.max(F.when(F.col("strategy") == model, F.col("total_return_pct"))).over(per)
    return metrics.withColumns({
        "best_baseline_return_pct": best,
        "verdict": F.when(own.isNull() | best.isNull(), "no comparison").when(own > best, "model beats best baseline")
        .otherwise("model does not beat the best baseline")})
