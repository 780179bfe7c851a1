"""Radix-selected quantiles and bin counts of many columns against NumPy."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from seriesmill.plans import wide


def table(spark, seed=1, n=3000):
    rng = np.random.default_rng(seed)
    pdf = pd.DataFrame({
        "k": rng.choice(["a", "b", "c"], n, p=[0.7, 0.29, 0.01]), "j": rng.integers(0, 2, n),
        "normal": rng.normal(0, 1, n), "large": rng.normal(0, 1, n) * 1e200, "ties": rng.integers(-2, 3, n).astype(float),
        "tight": 1e6 + rng.random(n) * 1e-6, "zero": np.where(rng.random(n) < 0.5, 0.0, -0.0), "none": np.nan,
        "gaps": np.where(rng.random(n) < 0.4, np.nan, rng.exponential(1, n)), "one": 3.25})
    names = [c for c in pdf if c not in ("k", "j")]
    df = spark.createDataFrame(pdf)
    return pdf, df.select("k", "j", *[F.when(~F.isnan(c), F.col(c)).alias(c) for c in names]).repartition(5), names


def test_ordered_bits_compare_like_the_values():
    values = np.array([-np.inf, -1e300, -1.5, -1e-300, -0.0, 0.0, 5e-324, 1.0, np.inf])
    bits = wide.ordered_bits(values)
    assert (np.diff(bits) >= 0).all() and bits[4] == bits[5] and (np.diff(bits) == 0).sum() == 1
    assert wide._value(bits).tolist() == values.tolist()


def test_quantiles_equal_numpy(spark):
    pdf, df, names = table(spark)
    probs = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    got = {(r["k"], r["j"], r["feature"], r["p"]): r["q"] for r in wide.quantiles(df, ["k", "j"], names, probs).collect()}
    want = {}
    for (k, j), part in pdf.groupby(["k", "j"]):
        for c in names:
            x = part[c].dropna().to_numpy()
            if len(x):
                want |= {(k, j, c, p): q for p, q in zip(probs, np.quantile(x, probs))}
    assert set(got) == set(want)
    for key, q in want.items():
        assert np.isclose(got[key], q, rtol=1e-13, atol=0), key


def test_small_packs_and_no_groups(spark, monkeypatch):
    pdf, df, names = table(spark, 2, 400)
    whole = sorted(map(tuple, wide.quantiles(df, ["k", "j"], names, [0.3]).collect()))
    monkeypatch.setattr(wide, "PACK_BYTES", 1)  # one series a pack
    assert sorted(map(tuple, wide.quantiles(df, ["k", "j"], names, [0.3]).collect())) == whole
    for r in wide.quantiles(df, [], names, [0.3]).collect():
        assert np.isclose(r["q"], np.quantile(pdf[r["feature"]].dropna(), 0.3), rtol=1e-13)
    assert wide.quantiles(df.where("false"), ["k", "j"], names, [0.3]).count() == 0


def test_bin_counts_equal_a_loop(spark):
    pdf, df, names = table(spark, 3)
    edges = [(k, c, [-1.0, 0.0, 0.5]) for k in ("a", "b") for c in ("normal", "ties", "gaps")] + [("a", "one", [])]
    table_ = spark.createDataFrame(edges, "k string, feature string, edges array<double>")
    got = {(r["k"], r["feature"], r["bin"]): (r["zero"], r["all"]) for r in wide.bin_counts(
        df.withColumn("m", F.col("j") == 0), ["k"], names, table_, {"zero": "m", "all": "true"}).collect()}
    for k, c, e in edges:
        part = pdf[(pdf.k == k) & pdf[c].notna()]
        at = np.searchsorted(np.array(e), part[c].to_numpy(), side="right")
        for b in range(len(e) + 1):
            assert got[k, c, b] == (int(((at == b) & (part.j == 0)).sum()), int((at == b).sum()))
    assert len(got) == 6 * 4 + 1
