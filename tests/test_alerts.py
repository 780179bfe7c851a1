import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from seriesmill.plans.blocks import Layout
from seriesmill.streaming import alerts as al, ingest


def brute(times, gap):
    kept, last = [], None
    for t in sorted(times):
        if last is None or t - last >= gap:
            kept.append(t)
            last = t
    return kept


@pytest.fixture(scope="module")
def stamps():
    rng = np.random.default_rng(3)
    dense = np.sort(rng.choice(40_000, 1_500, replace=False))  # no pause of an hour anywhere
    sparse = np.sort(rng.choice(900_000, 300, replace=False))
    pdf = pd.DataFrame({"asset": ["hot"] * len(dense) + ["b"] * len(sparse), "minute": np.concatenate([dense, sparse])})
    return pdf.assign(ts=pd.Timestamp("2024-01-01") + pd.to_timedelta(pdf.minute, unit="min"))


@pytest.mark.parametrize("long_segment", [2_000, 5])
def test_cooldown_equals_a_loop(spark, stamps, long_segment):
    """With a tiny limit nearly every segment goes through the jump joins."""
    df = spark.createDataFrame(stamps[["asset", "ts"]]).withColumn("ts", F.col("ts").cast("timestamp"))
    got = al.kept_alerts(df, Layout(step_ms=60_000, keys=("asset",), rows=200, bucket_steps=5_000), long_segment=long_segment).toPandas()
    for asset, part in stamps.groupby("asset"):
        want = brute(part.ts, pd.Timedelta(minutes=60))
        assert sorted(got[got.asset == asset].ts) == want


def test_cooldown_on_a_stream(spark, stamps, tmp_path):
    df = spark.createDataFrame(stamps[["asset", "ts"]]).withColumn("ts", F.col("ts").cast("timestamp"))
    half = F.lit("2024-01-15").cast("timestamp")
    path = str(tmp_path / "in")
    df.where(F.col("ts") < half).coalesce(1).write.parquet(path)
    df.where(F.col("ts") >= half).coalesce(1).write.mode("append").parquet(path)
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(path)
    got = ingest.drain(al.stream_kept_alerts(stream, ["asset"]), spark).toPandas()
    for asset, part in stamps.groupby("asset"):
        assert sorted(got[got.asset == asset].ts) == brute(part.ts, pd.Timedelta(minutes=60))


@pytest.mark.parametrize("signal,conf,quality,stale,covered,since,want", [
    ("no_trade", 0.9, 0.9, False, True, None, "signal 'no_trade' is non-alerting"),
    ("range_wait", 0.9, 0.9, False, True, None, "signal 'range_wait' is non-alerting"),
    ("long_bias", 0.9, 0.9, True, True, None, "model is stale"),
    ("long_bias", 0.9, 0.9, False, False, None, "data coverage below acceptable threshold"),
    ("long_bias", 0.6, 0.9, False, True, None, "direction confidence 0.6 < 0.65"),
    ("short_bias", 0.9, 0.5, False, True, None, "trade quality 0.5 < 0.6"),
    ("long_bias", 0.9, 0.9, False, True, 30.0, "cooldown active (30 < 60 min)"),
    ("long_bias", 0.9, 0.9, False, True, 60.0, "all gates passed"),
])
def test_gates_in_order(spark, signal, conf, quality, stale, covered, since, want):
    reason = al.gate_reason(F.lit(signal), F.lit(conf), F.lit(quality), F.lit(stale), F.lit(covered), F.lit(since).cast("double"))
    assert spark.range(1).select(reason).first()[0] == want
