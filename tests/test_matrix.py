"""The matrix in small blocks: same values, and many columns never travel with a year's look-back."""

import numpy as np

from seriesmill.operators import asof, matrix
from seriesmill.plans.blocks import Layout
from series import collected, frame, walk


def test_small_blocks_give_the_same_columns_in_the_same_order(spark, monkeypatch):
    df, L = frame(spark, walk(700, 5)), Layout(step_ms=3_600_000)
    whole = matrix.feature_matrix(df, L)
    want = collected(whole)
    monkeypatch.setattr(matrix, "DEEP_ROWS", 150)
    monkeypatch.setattr(matrix, "WIDE_ROWS", 90)
    cut = matrix.feature_matrix(df, L)
    assert cut.columns == whole.columns
    got = collected(cut)
    for c in matrix.feature_columns(whole):
        np.testing.assert_allclose(got[c].to_numpy(dtype=float), want[c].to_numpy(dtype=float), rtol=1e-8, atol=1e-9, equal_nan=True, err_msg=c)


def test_only_prices_look_back_over_a_year(spark, monkeypatch):
    seen, real = [], matrix.apply_features
    monkeypatch.setattr(matrix, "apply_features", lambda df, L, fs: seen.append((set(df.columns), L)) or real(df, L, fs))
    matrix.feature_matrix(frame(spark, walk(60, 7)), Layout(step_ms=3_600_000))
    wide = [L for columns, L in seen if "fear_greed" in columns]
    assert wide and all(L.before <= 256 and L.rows <= 8_192 for L in wide)
    assert any(L.before >= 8_760 and "fear_greed" not in columns for columns, L in seen)


def test_feeds_of_one_time_are_copied_to_the_salts_as_one_row(spark):
    df = frame(spark, walk(40, 3))
    feeds = {f"f{k}": df.select("ts", (df.close * (k + 1)).alias("v")) for k in range(3)}
    joined = asof.asof_join(df, feeds)
    got = collected(joined.selectExpr("symbol", "source", "market_type", "timeframe", "ts", "close", "f0.v AS a", "f1.v AS b", "f2.v AS c"))
    for k, c in enumerate("abc"):
        np.testing.assert_allclose(got[c], got["close"] * (k + 1))
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    # every copy is made of rows that have all feeds
    assert plan.count("Generate explode") <= 2
