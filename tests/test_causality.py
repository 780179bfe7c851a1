"""Features at a bar never depend on later bars."""

import numpy as np
from series import collected, frame, walk

from seriesmill.operators.matrix import feature_columns, feature_matrix
from seriesmill.plans.blocks import Layout

L = Layout(step_ms=3_600_000)
CUT = 220


def test_future_bars_change_nothing(spark):
    base = walk(300, 7)
    changed = base.copy()
    for c in ("open", "high", "low", "close", "volume"):
        changed.loc[changed.index > CUT, c] *= 3.7
    a = collected(feature_matrix(frame(spark, base), L))
    b = collected(feature_matrix(frame(spark, changed), L))
    names = feature_columns(feature_matrix(frame(spark, base), L))
    assert len(names) > 120
    for c in names:
        np.testing.assert_allclose(a[c][:CUT + 1].astype(float), b[c][:CUT + 1].astype(float), rtol=1e-12, atol=1e-12, equal_nan=True, err_msg=c)


def test_short_series_has_no_infinite_value(spark):
    m = feature_matrix(frame(spark, walk(30, 9)), L)
    values = collected(m)[feature_columns(m)].astype(float).to_numpy()
    assert not np.isinf(values).any()


def test_no_label_names_in_the_matrix(spark):
    names = feature_columns(feature_matrix(frame(spark, walk(30, 9)), L))
    assert not {"direction", "barrier_rr", "trade_quality", "regime", "cycle"} & set(names)
    assert {"returns_1", "ema_200", "rsi_14", "macd_hist", "atr", "market_structure_score", "doji", "obv"} <= set(names)
