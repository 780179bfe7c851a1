"""First passage by doubling against a loop over the bars ahead."""

import numpy as np
import pytest
from pyspark.sql import functions as F
from series import collected, frame, walk

from seriesmill.plans import passage
from seriesmill.plans.blocks import Layout, from_blocks, to_blocks


def plain(high, low, upper, lower, ahead):
    n, out = len(high), []
    for i in range(n):
        seen = max(0, min(ahead[i], n - 1 - i))
        hits = [j for j in range(1, seen + 1) if high[i + j] >= upper[i] or low[i + j] <= lower[i]]
        out.append((hits[0] if hits else 0, seen))
    return out


@pytest.mark.parametrize("seed", range(5))
def test_descent_equals_a_loop(seed):
    rng = np.random.default_rng(seed)
    for _ in range(40):
        n = rng.integers(1, 80)
        mid = np.cumsum(rng.normal(size=n))
        high, low = mid + rng.random(n), mid - rng.random(n)
        high[rng.random(n) < 0.1] = np.nan
        upper, lower = mid + rng.random(n) * 5, mid - rng.random(n) * 5
        upper[rng.random(n) < 0.2] = np.nan
        ahead = rng.integers(0, 100, n)
        at, seen = passage.descend(high, low, upper, lower, ahead)
        assert list(zip(at.tolist(), seen.tolist())) == plain(high, low, upper, lower, ahead)


def test_a_horizon_of_a_thousand_bars_in_small_blocks(spark):
    pdf = walk(2500, 5)
    df = frame(spark, pdf)
    layout = Layout(step_ms=3_600_000, rows=512, sub_rows=64, bucket_steps=256).reach(after=1000)
    bands = {"x": passage.Band(F.col("close") * 1.2, F.col("close") * 0.8, 1000)}
    got = collected(from_blocks(passage.with_passage(to_blocks(df, layout), layout, bands)))
    c = pdf.close.to_numpy()
    want = plain(pdf.high.to_numpy(), pdf.low.to_numpy(), c * 1.2, c * 0.8, np.full(len(c), 1000))
    assert list(zip(got.x_at, got.x_seen)) == want
    last = [c[i + s] for i, (_, s) in enumerate(want)]
    assert np.allclose(got.x_last, last) and (got.x_up | got.x_down).tolist() == [a > 0 for a, _ in want]
