"""Incremental ingest: bars and marks from streams, safe against re-delivery."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from seriesmill.keys import SERIES_KEYS
from seriesmill.sources.storage import merge_bars, scratch


def bar_stream(spark: SparkSession, path: str, schema, files_per_batch: int = 64) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def distinct_bars(bars: DataFrame, keys: Sequence[str] = SERIES_KEYS, ts: str = "ts", lateness: str = "30 days") -> DataFrame:
    """Each (series, time) once, however often it is delivered within the lateness.

    For feeds whose lateness is bounded; ``drain`` fails if a row comes later than that.
    History in any order goes through ``ingest_bars``.
    """
    return bars.withWatermark(ts, lateness).dropDuplicatesWithinWatermark([*keys, ts])


def stream_watermarks(bars: DataFrame, keys: Sequence[str] = SERIES_KEYS, ts: str = "ts") -> DataFrame:
    return bars.groupBy(*keys).agg(F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts"), F.count(F.lit(1)).alias("rows"))


def stream_bars(ticks: DataFrame, every: str, *, symbol: str = "symbol", ts: str = "ts", price: str = "price",
                order: Sequence[str] = ("ts",), lateness: str = "1 hour") -> DataFrame:
    """Tumbling event-time bars from ticks; a window is emitted once the watermark passes it."""
    first: Column = F.struct(*[F.col(c) for c in order])
    return (ticks.withWatermark(ts, lateness).groupBy(F.col(symbol).alias("symbol"), F.window(ts, every).alias("w"))
            .agg(F.min_by(price, first).alias("open"), F.max(price).alias("high"), F.min(price).alias("low"),
                 F.max_by(price, first).alias("close"), F.count(F.lit(1)).cast("double").alias("volume"))
            .select("symbol", F.col("w.start").alias("ts"), "open", "high", "low", "close", "volume"))


def ingest_bars(bars: DataFrame, path: str, checkpoint: str, keys: Sequence[str] = SERIES_KEYS, ts: str = "ts"):
    """Every micro-batch is merged into the stored bars: no order is assumed, nothing is too late.

    Repeated rows and repeated batches change nothing; corrections replace what is stored.
    """
    def apply(batch: DataFrame, _: int) -> None:
        merge_bars(batch, path, keys, ts)
    return bars.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def open_bars(ticks: DataFrame, every_ms: int, *, symbol: str = "symbol", ts: str = "ts", price: str = "price",
              order: Sequence[str] = ("ts",), lateness_ms: int = 3_600_000) -> DataFrame:
    """The closing pass: bars of the windows a stream of these ticks leaves open, as a batch."""
    newest = ticks.agg(F.max(F.unix_millis(ts)).alias("t")).first()["t"]
    if newest is None:
        begin = 0
    else:
        # windows up to the watermark are closed; the stream has emitted them
        begin = (newest - lateness_ms) // every_ms * every_ms
    first: Column = F.struct(*[F.col(c) for c in order])
    start = F.timestamp_millis(F.floor(F.unix_millis(ts) / F.lit(every_ms)) * F.lit(every_ms))
    return (ticks.where(F.col(ts) >= F.timestamp_millis(F.lit(begin))).groupBy(F.col(symbol).alias("symbol"), start.alias("ts"))
            .agg(F.min_by(price, first).alias("open"), F.max(price).alias("high"), F.min(price).alias("low"),
                 F.max_by(price, first).alias("close"), F.count(F.lit(1)).cast("double").alias("volume")))


def _plain(progress) -> dict:
    return progress if isinstance(progress, dict) else json.loads(progress.json)


def drain(stream: DataFrame, spark: SparkSession, mode: str = "append") -> DataFrame:
    """Run a stream over what is available now and read the sink table back.

    Complete and update results are small per-key tables; each micro-batch is stored under
    its number and the newest state per key is what the last complete batch holds.
    """
    target, marks = scratch(spark, "stream"), scratch(spark, "marks")
    writer = stream.writeStream.option("checkpointLocation", marks).outputMode(mode).trigger(availableNow=True)
    if mode == "append":
        query = writer.format("parquet").option("path", target).start()
    else:
        def keep(batch: DataFrame, number: int) -> None:
            batch.write.mode("overwrite").parquet(f"{target}/batch={number}")
        query = writer.foreachBatch(keep).start()
    query.awaitTermination()
    lost = sum(int(o.get("numRowsDroppedByWatermark", 0)) for p in query.recentProgress for o in _plain(p)["stateOperators"])
    if lost:
        raise RuntimeError(f"{lost} rows came later than the watermark allows")
    if mode == "append":
        return spark.read.schema(stream.schema).parquet(target)
    done = spark.read.parquet(target)
    newest = done.agg(F.max("batch").alias("n")).first()["n"]
    return done.where(F.col("batch") == newest).drop("batch")  # reads that partition only
