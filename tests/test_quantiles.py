import numpy as np
import pandas as pd
import pytest

from seriesmill.operators.evaluate import average_precision, roc_auc
from seriesmill.plans.gram import correlations
from seriesmill.plans.quantiles import exact_quantiles


@pytest.mark.parametrize("accuracy", [30, 10_000])
def test_exact_quantiles(spark, accuracy):
    """A coarse sketch forces the bracket path; the result stays exact."""
    rng = np.random.default_rng(0)
    a = np.concatenate([rng.lognormal(0, 2, 3000), np.full(2500, 1.0)])  # hot ties
    pdf = pd.DataFrame({"g": ["a"] * len(a) + ["b"] * 7, "v": np.concatenate([a, rng.normal(size=7)])})
    probs = [0.0, 0.1, 0.33, 0.5, 0.85, 1.0]
    got = exact_quantiles(spark.createDataFrame(pdf), ["g"], "v", probs, accuracy).toPandas()
    for g, part in pdf.groupby("g"):
        for p in probs:
            have = got[(got.g == g) & (got.p == p)].q.iloc[0]
            assert have == pytest.approx(np.quantile(part.v, p), rel=1e-12)


def test_ranking_scores_against_pairs(spark):
    rng = np.random.default_rng(1)
    score, y = rng.integers(0, 40, 600), rng.integers(0, 2, 600)
    df = spark.createDataFrame(pd.DataFrame({"y": y, "s": score.astype(float)}))
    pos, neg = score[y == 1], score[y == 0]
    auc = np.mean([(p > neg).mean() + 0.5 * (p == neg).mean() for p in pos])
    assert roc_auc(df, "y", "s").first()["auc"] == pytest.approx(auc)
    ap, recall = 0.0, 0.0
    for t in sorted(set(score), reverse=True):
        hit = score >= t
        r = y[hit].sum() / y.sum()
        ap, recall = ap + (r - recall) * y[hit].mean(), r
    assert average_precision(df, "y", "s").first()["average_precision"] == pytest.approx(ap)


def test_pairwise_correlation_with_gaps(spark):
    rng = np.random.default_rng(2)
    pdf = pd.DataFrame(rng.normal(1e6, 1, (500, 3)), columns=list("xyz"))
    pdf["y"] += pdf.x
    pdf.loc[rng.random(500) < 0.3, "y"] = np.nan
    got = {(r.a, r.b): r.r for r in correlations(spark.createDataFrame(pdf), ["x", "y", "z"]).collect()}
    want = pdf.corr()
    for (a, b), r in got.items():
        assert r == pytest.approx(want.loc[a, b], abs=1e-9)
