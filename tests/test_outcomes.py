import numpy as np
import pandas as pd
import pytest
from series import collected, frame, walk
from pyspark.sql import functions as F

from seriesmill.operators import indicators as ind, outcomes as out
from seriesmill.plans.blocks import Layout

L = Layout(step_ms=3_600_000)


def loop(side, entry, atr, size, bars, max_bars):
    """One trade, bar by bar."""
    slip = lambda p: min(15.0, max(2.0, 0.02 * atr / p * 1e4)) / 1e4
    stop0 = stop = entry - side * 1.5 * atr
    tps, shares = [entry + side * 1.5 * atr * r for r in (1, 2, 3)], (0.33, 0.33, 0.34)
    left, done, pnl = 1.0, [False] * 3, 0.0

    def close(price, share):
        px = price * (1 - side * slip(price))
        return ((px - entry) * side - px * 4e-4) * share * size

    for k, (h, lo, c) in enumerate(bars[: max_bars - 1]):
        if (lo <= stop) if side > 0 else (h >= stop):
            return pnl + close(stop, left), "stop", stop0
        for i in range(3):
            if not done[i] and ((h >= tps[i]) if side > 0 else (lo <= tps[i])):
                share = left if i == 2 else shares[i]
                pnl, left, done[i] = pnl + close(tps[i], share), left - share, True
                if i == 2:
                    return pnl, "tp3", stop0
                stop = entry if i == 0 else tps[0]
        if k + 2 >= max_bars:
            return pnl + close(c, left), "vertical_barrier", stop0
    return pnl + close(bars[-1][2], left), "end_of_data", stop0


def test_ladder_equals_a_loop(spark):
    pdf = walk(160, 21)
    df = frame(spark, pdf).withColumns({"atr": F.lit(450.0), "side": F.when(F.col("close") > F.col("open"), 1).otherwise(-1)})
    got = collected(ind.on_bars(df, Layout(step_ms=3_600_000, rows=50, bucket_steps=33), lambda d, l: out.add_entry(d),
                                lambda d, l: out.add_ladder(d, l, 12), after=12))
    hlc = list(zip(pdf.high, pdf.low, pdf.close))
    reasons = set()
    for i in range(159):
        row = got.iloc[i]
        pnl, reason, stop0 = loop(row.side, row.entry_price, 450.0, row["size"], hlc[i + 1:], 12)
        assert row.exit_reason == reason and row.realized_pnl == pytest.approx(pnl, rel=1e-9, abs=1e-9)
        assert row.rr_realized == pytest.approx(pnl / (abs(row.entry_price - stop0) * row["size"]), rel=1e-9, abs=1e-12)
        reasons.add(reason)
    assert {"stop", "tp3", "vertical_barrier"} <= reasons
    assert pd.isna(got.iloc[159].exit_reason)


def test_equity_metrics(spark):
    rng = np.random.default_rng(2)
    pnl = rng.normal(1, 50, 120)
    ts = pd.date_range("2024-01-01", periods=120, freq="h")
    t = spark.createDataFrame(pd.DataFrame({"strategy": "m", "close_ts": ts, "realized_pnl": pnl})).withColumn("close_ts", F.col("close_ts").cast("timestamp"))
    layout = Layout(step_ms=3_600_000, keys=("strategy",), ts="close_ts", rows=25, bucket_steps=11)
    m = out.equity_metrics(out.equity_curve(t, layout), layout).first()
    eq = 10_000 + np.cumsum(pnl)
    ret = np.diff(eq) / eq[:-1]
    assert m["max_drawdown_pct"] == pytest.approx(((eq - np.maximum.accumulate(eq)) / np.maximum.accumulate(eq)).min() * 100)
    assert m["sharpe"] == pytest.approx(ret.mean() / ret.std() * np.sqrt(len(ret)))
    assert m["sortino"] == pytest.approx(ret.mean() / ret[ret < 0].std() * np.sqrt(len(ret)))
