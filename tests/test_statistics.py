"""Drift, selection, thresholds, promotion and scorecards."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from seriesmill.operators import drift, monitor, scorecard as sc, selection as sel, signals as sig


def psi(spark, ref, cur):
    pdf = pd.DataFrame({"sample": ["ref"] * len(ref) + ["cur"] * len(cur), "value": np.concatenate([ref, cur]), "g": 0})
    return drift.psi_long(spark.createDataFrame(pdf), ["g"]).first()["psi"]


def test_psi_properties(spark):
    rng = np.random.default_rng(0)
    base = rng.normal(size=800)
    assert psi(spark, base, base) == pytest.approx(0, abs=1e-12)
    small, large = psi(spark, base, rng.normal(0.3, 1, 800)), psi(spark, base, rng.normal(2, 1, 800))
    assert 0 < small < large and large > 0.25
    assert psi(spark, np.ones(50), np.ones(50)) == 0.0


def test_psi_equals_numpy(spark):
    rng = np.random.default_rng(3)
    ref, cur = rng.normal(size=500).round(1), rng.normal(0.4, 1.2, 300).round(1)
    edges = np.unique(np.quantile(ref, np.linspace(0, 1, 11)))
    edges[0], edges[-1] = -np.inf, np.inf
    r = np.clip(np.histogram(ref, edges)[0] / len(ref), 1e-6, None)
    c = np.clip(np.histogram(cur, edges)[0] / len(cur), 1e-6, None)
    assert psi(spark, ref, cur) == pytest.approx(np.sum((c - r) * np.log(c / r)), rel=1e-9)


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(5)
    pdf = pd.DataFrame(rng.normal(size=(600, 6)), columns=[f"f{k}" for k in range(6)])
    pdf["copy"] = pdf.f0 + rng.normal(0, 1e-3, 600)
    pdf["nearzero"] = 1.0
    pdf["mostlynan"] = np.where(rng.random(600) < 0.9, np.nan, 1.0)
    pdf["y"], pdf["id"] = (pdf.f0 > 0).astype(int), np.arange(600)
    return pdf


COLUMNS = [*[f"f{k}" for k in range(6)], "copy", "nearzero", "mostlynan"]


def selected(spark, train, val):
    nulls = lambda p: spark.createDataFrame(p.astype(object).where(p.notna(), None), ", ".join(
        f"{c} {'int' if c in ('y', 'id') else 'double'}" for c in p.columns))
    return sel.select_features(nulls(train), nulls(val), COLUMNS, "y", ["id"], always_keep=("f3",), repeats=2, trees=5).toPandas().set_index("feature")


def test_selection_stages(spark, table):
    r = selected(spark, table.iloc[:400], table.iloc[400:])
    assert r.stage["mostlynan"] == "null_ratio" and r.stage["nearzero"] == "variance" and r.stage["copy"] == "correlation"
    assert r.kept["f3"] and r.kept["f0"]
    assert r.score.idxmax() == "f0"


def test_selection_never_reads_test_rows(spark, table):
    df = spark.createDataFrame(table[["f0", "f1", "f2", "y"]])
    train = df.limit(0).unionByName(spark.createDataFrame(table[["f0", "f1", "f2", "y"]].iloc[:400]))
    a = sel.mutual_information(train, ["f0", "f1", "f2"], "y").toPandas().set_index("feature").score
    assert a.idxmax() == "f0" and (a >= 0).all()


def test_always_kept_partner_is_dropped_instead(spark):
    pairs = spark.createDataFrame([("a", "b", 0, 1, 0.99), ("b", "c", 1, 2, 0.99)], "a string, b string, _a int, _b int, r double")
    assert sel.correlated_drops(pairs, always_keep=("b",)) == [("a", "a", "b"), ("c", "b", "c")]


def test_threshold_search_equals_a_loop(spark):
    rng = np.random.default_rng(8)
    p = rng.dirichlet([1, 1, 1], 400)
    y = np.where(rng.random(400) < 0.6, p.argmax(1), rng.integers(0, 3, 400))
    df = spark.createDataFrame(pd.DataFrame({"p_down": p[:, 0], "p_sideways": p[:, 1], "p_up": p[:, 2], "y": y}))
    best = None
    for t in sig.GRID:
        for lo in sig.GRID:
            for sh in sig.GRID:
                if lo < t or sh < t:
                    continue
                pred = np.full(400, -1)
                top, c = p.max(1), p.argmax(1)
                pred[(top >= t) & (c == 2) & (p[:, 2] >= lo)] = 2
                pred[(top >= t) & (c == 0) & (p[:, 0] >= sh)] = 0
                pred[(top >= t) & (c == 1)] = 1
                m = pred >= 0
                if m.sum() < 20 or len(set(pred[m])) < 2:
                    continue
                prec = [(y[m][pred[m] == k] == k).mean() if (pred[m] == k).any() else 0 for k in (2, 0)]
                if min(prec) < 0.45:
                    continue
                f = [2 * ((pred[m] == k) & (y[m] == k)).sum() / max(1, (pred[m] == k).sum() + (y[m] == k).sum())
                     for k in range(3) if ((pred[m] == k) | (y[m] == k)).any()]
                if best is None or np.mean(f) > best[0] + 1e-12:
                    best = (np.mean(f), lo, sh, t)
    got = sig.tune_thresholds(df).first()
    assert (got["long_threshold"], got["short_threshold"], got["no_trade_threshold"]) == best[1:]
    assert got["macro_f1"] == pytest.approx(best[0])


def test_promotion_gates(spark):
    schema = "model_id string, direction_macro_f1 double, backtest_profit_factor double, max_drawdown_pct double, expectancy_r double"
    c = spark.createDataFrame([("good", 0.5, 1.3, -10.0, 0.1), ("weak", 0.41, 1.3, -10.0, 0.1), ("deep", 0.5, 1.3, -30.0, 0.1),
                               ("untested", 0.5, 0.0, 0.0, 0.0)], schema)
    p = spark.createDataFrame([("prod", 0.405, 1.2, -20.0, 0.1)], schema)
    got = {r.model_id: r.approved for r in monitor.promotion_gate(c, p).collect()}
    assert got == {"good": True, "weak": False, "deep": False, "untested": True}
    assert all(r.approved for r in monitor.promotion_gate(c, p.limit(0)).collect())


def test_scorecard_states(spark):
    df = spark.createDataFrame([(None, None, None, 75.0), (25.0, 4.0, 0.5, 10.0)], "rsi_14 double, ema_stack_score double, macd_hist double, fear_greed double")
    rows = df.select(sc.trade_checklist(df).alias("t"), sc.buy_checklist(df).alias("b")).collect()
    assert rows[0].t.rsi_state == rows[0].t.macd_state == rows[0].t.funding_state == "unavailable"
    assert rows[0].b.dca_suggested == "true" and rows[1].b.dca_suggested == "false"
    assert (rows[1].t.rsi_state, rows[1].t.trend_direction, rows[1].t.macd_state) == ("oversold", "strong_up", "bullish_histogram_rising")
    assert len(rows[0].t) == 27


def test_strategy_is_a_column(spark):
    df = spark.range(3).select(F.lit(2.0).alias("ema_9"), F.lit(1.0).alias("ema_21"))
    assert df.select(sig.ema_trend()["side"]).distinct().first()[0] == 1
