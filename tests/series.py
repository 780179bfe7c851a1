"""Bar frames and comparisons that several test modules use."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F


def walk(n, seed, symbol="AAA", start="2024-01-01"):
    """A random-walk hourly bar frame."""
    rng = np.random.default_rng(seed)
    close = 30_000 * np.exp(np.cumsum(rng.normal(0, 0.01, n)))
    open_ = np.concatenate([[30_000.0], close[:-1]])
    return pd.DataFrame({
        "source": "s", "market_type": "spot", "symbol": symbol, "timeframe": "1h",
        "ts": pd.date_range(start, periods=n, freq="h"), "open": open_,
        "high": np.maximum(open_, close) * (1 + rng.uniform(0, 0.003, n)),
        "low": np.minimum(open_, close) * (1 - rng.uniform(0, 0.003, n)),
        "close": close, "volume": rng.uniform(1, 100, n)})


def frame(spark, pdf):
    df = spark.createDataFrame(pdf)
    return df.withColumn("ts", F.col("ts").cast("timestamp")) if "ts" in pdf else df


def collected(df, by=("symbol", "ts")):
    return df.toPandas().sort_values(list(by)).reset_index(drop=True)
