"""Drift from stored histograms against a loop over the values."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from seriesmill.operators import drift
from seriesmill.plans import wide


def table(seed=1):
    rng = np.random.default_rng(seed)
    n = 1200
    month = np.repeat(np.arange(4), n // 4)
    return pd.DataFrame({"symbol": rng.choice(["A", "B"], n, p=[0.8, 0.2]), "month": month,
                         "same": rng.normal(size=n), "moved": rng.normal(size=n) + 2 * (month == 3), "flat": 1.5,
                         "gaps": np.where(rng.random(n) < 0.5, np.nan, rng.exponential(size=n)), "none": np.nan})


NAMES = ["same", "moved", "flat", "gaps", "none"]


def frame(spark, pdf):
    df = spark.createDataFrame(pdf)
    return df.select("symbol", "month", *[F.when(~F.isnan(c), F.col(c)).alias(c) for c in NAMES])


def plain(ref, cur, bins=10):
    step = lambda x: wide.ordered_bits(np.sort(x)) >> np.int64(64 - wide.BITS[0])
    r, c = step(ref), step(cur)
    edges = sorted({int(r[int(np.floor(k / bins * (len(r) - 1)))]) for k in range(bins + 1)})
    if len(edges) < 3 or len(ref) < 2 or len(cur) < 2:
        return 0.0
    at = lambda x: np.clip(np.searchsorted(edges[1:-1], x, side="right"), 0, len(edges) - 2)
    share = lambda x: np.maximum(np.bincount(at(x), minlength=len(edges) - 1) / len(x), 1e-6)
    a, b = share(r), share(c)
    return float(((b - a) * np.log(b / a)).sum())


def test_state_built_bit_by_bit_equals_one_pass_and_a_loop(spark, tmp_path):
    pdf = table()
    df = frame(spark, pdf)
    slow, once = (drift.DriftState(spark, f"{tmp_path}/{k}", NAMES, ["symbol"]) for k in ("slow", "once"))
    for month in (2, 0, 3, 1, 0):  # in any order, one delivered twice
        slow.add(df.where(F.col("month") == month), F.col("month"))
    once.add(df, F.col("month"))
    ask = lambda s: {(r["symbol"], r["feature"]): r["psi"] for r in s.check(F.col("period") < 3, F.col("period") == 3).collect()}
    got = ask(slow)
    assert got == ask(once)
    for symbol, part in pdf.groupby("symbol"):
        for c in NAMES:
            ref, cur = (part[(part.month < 3) == old][c].dropna().to_numpy() for old in (True, False))
            if len(ref):
                assert np.isclose(got[symbol, c], plain(ref, cur), atol=1e-12)
    assert ("A", "none") not in got and got["A", "flat"] == 0 and got["A", "moved"] > 0.25 > got["A", "same"]


def test_state_gives_the_severity_of_the_exact_check(spark, tmp_path):
    df = frame(spark, table(2)).where("symbol = 'A'")
    state = drift.DriftState(spark, f"{tmp_path}/s", NAMES, ["symbol"])
    state.add(df, F.col("month"))
    got = {r["feature"]: r["severity"] for r in state.check(F.col("period") < 3, F.col("period") == 3).collect()}
    exact = drift.drift_table(df.withColumn("sample", F.when(F.col("month") < 3, "ref").otherwise("cur")), NAMES, ["symbol"])
    assert got == {r["feature"]: r["severity"] for r in exact.collect()} and got["moved"] == "significant"
