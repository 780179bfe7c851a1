import numpy as np
import pandas as pd
import pytest
from series import collected, frame, walk

from seriesmill.operators.asof import asof_columns


@pytest.mark.parametrize("keyed", [True, False])
@pytest.mark.parametrize("grid", [None, 3_600_000])
def test_equals_merge_asof(spark, keyed, grid):
    rng = np.random.default_rng(4)
    left = pd.concat([walk(300, 1, "A"), walk(200, 2, "B")])
    stamps = pd.Timestamp("2023-12-31") + pd.to_timedelta(np.sort(rng.choice(15 * 86_400, 900, replace=False)), unit="s")
    stamps = stamps.append(pd.DatetimeIndex(["2024-01-02 05:00:00", "2024-01-02 05:00:00.000500"]))
    right = pd.DataFrame({"ts": stamps, "x": rng.normal(size=len(stamps))}).drop_duplicates("ts").sort_values("ts")
    right.loc[rng.random(len(right)) < 0.3, "x"] = np.nan  # a missing value in the latest row stays missing
    if keyed:
        right = pd.concat([right.iloc[::2].assign(symbol="A"), right.iloc[1::2].assign(symbol="B")])
    feed = frame(spark, right.replace({np.nan: None}))
    got = collected(asof_columns(frame(spark, left), {"f": feed}, on=("symbol",) if keyed else (), bucket_ms=50 * 3_600_000,
                                 fanout=3, grid_ms=grid))
    want = pd.merge_asof(left.sort_values("ts"), right.sort_values("ts"), on="ts", by="symbol" if keyed else None)
    want = want.sort_values(["symbol", "ts"]).reset_index(drop=True)
    np.testing.assert_allclose(got.x.astype(float), want.x, equal_nan=True)


def test_dense_feeds_of_the_registered_join_are_reduced_before_they_meet_the_bars(spark, monkeypatch):
    from seriesmill.catalog import QUERIES, context
    seen, join = [], context.ctx.join_derivatives
    monkeypatch.setattr(context.ctx, "join_derivatives", lambda bars, feeds, **options: seen.append(options) or join(bars, feeds, **options))
    QUERIES["j1_asof_join"](spark, "/root/testdata/sf0.001")
    assert seen == [{"grid_ms": context.HOURLY.step_ms}]
