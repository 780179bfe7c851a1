"""The block layout: any block size gives the values of one whole series."""

import numpy as np
import pandas as pd
import pytest
from series import collected, frame, walk
from pyspark.sql import functions as F

from seriesmill.operators import indicators as ind, labels as lab, patterns as pat, structure as stc
from seriesmill.plans.blocks import Layout, Running, Smooth, ema_reach, span, with_long_rolling, with_running, with_smooth

WHOLE = Layout(step_ms=3_600_000)
SMALL = Layout(step_ms=3_600_000, rows=70, sub_rows=32, bucket_steps=41)


@pytest.fixture(scope="module")
def bars(spark):
    # one series holds most rows
    return frame(spark, pd.concat([walk(900, 1, "HOT"), walk(60, 2, "B"), walk(1, 3, "ONE")])).persist()


def same(a, b):
    assert len(a) == len(b)
    for c in a.columns:
        if a[c].dtype.kind == "f":
            np.testing.assert_allclose(a[c], b[c], rtol=1e-9, atol=1e-9, equal_nan=True, err_msg=c)
        else:
            assert (a[c].fillna("") == b[c].fillna("")).all(), c


@pytest.mark.parametrize("steps,before,after", [
    ([ind.add_returns, ind.add_sma, ind.add_bollinger, ind.add_true_range, ind.add_volume, ind.add_vwap, ind.add_volatility], 201, 0),
    ([ind.add_obv, ind.add_extremes], 1, 0),
    ([stc.add_swings, stc.add_structure_score, stc.add_character_change], 11, 0),
    ([stc.range_breakout(20), stc.add_gaps, stc.add_order_blocks, pat.add_two_bar_patterns], 60, 0),
    ([ind.add_rsi, ind.add_rsi_state, ind.add_macd], ind.RSI_LOOKBACK + ind.MACD_LOOKBACK, 0),
    ([ind.add_true_range, ind.add_atr, lambda d, L: lab.add_direction(d, L, 1.5, 20, 20),
      lambda d, L: lab.add_trade_quality(d, L, 40, 40)], ind.ATR_LOOKBACK, 40),
    ([lambda d, L: lab.add_cycle(d, L, ["2023-01-01"], 100)], 100, 0),
    ([lambda d, L: with_long_rolling(d, L, {"a": ("max", "close", 90), "b": ("min", "low", 90), "c": ("mean", "close", 130)})], 130, 0),
])
def test_block_size_does_not_matter(bars, steps, before, after):
    same(collected(ind.on_bars(bars, SMALL, *steps, before=before, after=after)),
         collected(ind.on_bars(bars, WHOLE, *steps, before=before, after=after)))


def test_smoothing_equals_pandas(bars):
    specs = {"e9": Smooth("close", span(9), 9), "w14": Smooth("close", 1 / 14, 14), "e50": Smooth("close", span(50), 50)}
    got = collected(ind.on_bars(bars, SMALL, lambda d, L: with_smooth(d, L, specs), before=ema_reach(span(50))))
    for name, alpha, n in (("e9", 0.2, 9), ("w14", 1 / 14, 14), ("e50", 2 / 51, 50)):
        want = got.groupby("symbol").close.transform(lambda x: x.ewm(alpha=alpha, adjust=False, min_periods=n).mean())
        np.testing.assert_allclose(got[name], want, rtol=1e-12, equal_nan=True)


def test_short_reach_is_refused(bars):
    with pytest.raises(ValueError, match="shorter than the reach"):
        ind.on_bars(bars, SMALL, lambda d, L: with_smooth(d, L, {"e": Smooth("close", span(50), 1)}), before=10)


def test_running_equals_pandas(bars):
    specs = {"s": Running("sum", "volume"), "m": Running("max", "high"), "l": Running("last", "x"), "p": Running("last", "x", strict=True)}
    step = lambda d, L: with_running(d.withColumn("x", F.when(F.col("volume") > 90, F.col("close"))), L, specs)
    got = collected(ind.on_bars(bars, SMALL, step, before=5))
    g = got.groupby("symbol")
    np.testing.assert_allclose(got.s, g.volume.cumsum())
    np.testing.assert_allclose(got.m, g.high.cummax())
    filled = g.x.ffill()
    np.testing.assert_allclose(got.l, filled, equal_nan=True)
    np.testing.assert_allclose(got.p, filled.groupby(got.symbol).shift(1), equal_nan=True)


def test_groups_stay_bounded(bars):
    from seriesmill.plans.blocks import to_blocks
    L = SMALL.reach(before=30, after=10)
    biggest = to_blocks(bars, L).groupBy(*L.keys, "_block").count().agg(F.max("count")).first()[0]
    assert biggest <= L.rows + L.before + L.after
