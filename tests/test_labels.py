import pandas as pd
import pytest
from series import collected, frame, walk
from pyspark.sql import functions as F

from seriesmill.operators import labels as lab
from seriesmill.plans.blocks import Layout, from_blocks, to_blocks

L = Layout(step_ms=3_600_000).reach(after=20)


def hand(spark, closes, highs=None, lows=None, atr=5.0):
    n = len(closes)
    return frame(spark, pd.DataFrame({
        "source": "s", "market_type": "spot", "symbol": "A", "timeframe": "1h", "ts": pd.date_range("2024-01-01", periods=n, freq="h"),
        "open": closes, "high": highs or [c + 0.5 for c in closes], "low": lows or [c - 0.5 for c in closes],
        "close": [float(c) for c in closes], "volume": 1.0})).withColumn("atr", F.lit(atr).cast("double"))


@pytest.mark.parametrize("closes,highs,lows,atr,want,rr", [
    ([100, 102, 104, 106, 105], None, None, 5.0, 2, 1.0),
    ([100, 98, 96, 94, 96], None, None, 5.0, 0, -1.0),
    ([100, 101, 100, 101, 100], None, None, 5.0, 1, 0.0),
    ([100, 100], [110, 110], [90, 90], 5.0, -1, 0.0),
    ([100, 102, 104], None, None, None, -1, None),
])
def test_direction_paths(spark, closes, highs, lows, atr, want, rr):
    df = from_blocks(lab.add_direction(to_blocks(hand(spark, closes, highs, lows, atr), L), L, 1.0, 4, 4))
    first = collected(df).iloc[0]
    assert first.direction == want
    assert (first.barrier_rr == rr) if rr is not None else pd.isna(first.barrier_rr)
    assert collected(df).iloc[-1].direction == -1  # nothing lies ahead of the last bar


def test_stop_before_target_on_one_bar(spark):
    df = hand(spark, [100, 100, 100], [100, 111, 100], [100, 94, 100])
    df = to_blocks(df, L).withColumn("direction", F.lit(2))
    assert collected(from_blocks(lab.add_trade_quality(df, L, 10, 10))).trade_quality.tolist() == [0, 0, 0]


def test_quality_without_bars(spark):
    rows = spark.createDataFrame([(2, 1.0), (0, -1.0), (1, 0.0), (-1, 0.0)], "direction int, rr double")
    got = rows.select(lab.quality_from_outcome(F.col("direction"), F.col("rr")).alias("q")).toPandas().q.tolist()
    assert got == [1, 1, 0, 0]


def test_direction_equals_a_loop(spark):
    pdf = walk(200, 11)
    df = frame(spark, pdf).withColumn("atr", F.lit(400.0))
    got = collected(from_blocks(lab.add_direction(to_blocks(df, L), L, 1.5, 20, 20)))
    h, lo, c = pdf.high.to_numpy(), pdf.low.to_numpy(), pdf.close.to_numpy()
    for i in range(199):
        up, dn, want = c[i] + 600, c[i] - 600, 1
        for j in range(i + 1, min(i + 20, 199) + 1):
            if h[j] >= up or lo[j] <= dn:
                want = -1 if h[j] >= up and lo[j] <= dn else (2 if h[j] >= up else 0)
                break
        assert got.direction[i] == want
