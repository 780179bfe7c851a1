"""Where derived files go, and table sinks."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from seriesmill.keys import OHLCV, SERIES_KEYS
from seriesmill.operators.asof import keep_last
from seriesmill.session import ensure_checkpoint_dir

#: Touched partitions are named to the scan (and broadcast) up to this many.
MANY_PARTITIONS = 100_000


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and go on from the files."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def exists(spark: SparkSession, path: str) -> bool:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)


def partitions_of(ts: str = "ts") -> Column:
    """Bars are stored by series and month: an increment touches the months it has rows of."""
    return F.date_format(F.col(ts), "yyyy-MM")


def merge_bars(new: DataFrame, path: str, keys: Sequence[str] = SERIES_KEYS, ts: str = "ts",
               rows_per_file: int = 1_000_000) -> int:
    """Merge bars into the table under ``path``; returns the number of partitions rewritten.

    Only the (series, month) partitions that ``new`` has rows of are read, merged (a new row
    replaces the stored one of the same time, everything else stays) and replaced.  The
    merged rows are written down in full before any partition is touched, and merging the
    same rows again changes nothing, so a job that dies while it publishes is simply repeated.
    """
    spark, parts = new.sparkSession, [*keys, "month"]
    fresh = keep_last(new.withColumns({"month": partitions_of(ts), "_rank": F.lit(1)}), [*parts, ts], ["_rank"])
    fresh = staged(fresh, "increment")
    touched = staged(fresh.groupBy(*parts).count(), "touched")
    count = touched.count()
    if not count:
        return 0
    if exists(spark, path):
        stored = spark.read.option("basePath", path).parquet(path)
        stored = stored.select(*[F.col(f.name).cast(f.dataType) if f.name in stored.columns else F.lit(None).cast(f.dataType).alias(f.name)
                                 for f in fresh.drop("_rank").schema.fields])
        kept = stored.join(F.broadcast(touched) if count <= MANY_PARTITIONS else touched, parts, "left_semi")
        merged = keep_last(kept.withColumn("_rank", F.lit(0)).unionByName(fresh), [*parts, ts], ["_rank"])
    else:
        merged = fresh
    done = staged(merged.drop("_rank"), "merged")
    # one writer per partition and million rows, whatever the number of series
    writers = F.floor(F.unix_seconds(F.col(ts)) / 86_400) % F.lit(31)
    sizes = done.groupBy(*parts).agg(F.ceil(F.count(F.lit(1)) / rows_per_file).alias("_files"))
    (done.join(F.broadcast(sizes) if count <= MANY_PARTITIONS else sizes, parts).withColumn("_file", writers % F.col("_files"))
     .repartition(*parts, "_file").drop("_files", "_file").sortWithinPartitions(*parts, ts)
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*parts).parquet(path))
    return count


def write_bars(bars: DataFrame, path: str, keys: Sequence[str] = SERIES_KEYS, ts: str = "ts") -> None:
    """Hive-partitioned Parquet; what is stored and not in ``bars`` stays."""
    merge_bars(bars, path, keys, ts)


def read_bars(spark: SparkSession, path: str, columns: Sequence[str] = OHLCV, **keys: str) -> DataFrame:
    """Scan with partition and column pruning: only the wanted series and columns are read."""
    df = spark.read.parquet(path)
    for k, v in keys.items():
        df = df.where(F.col(k) == v)
    return df.select(*SERIES_KEYS, "ts", *columns)


def upserted(existing: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Both tables with one row per key; a new row replaces a stored one."""
    both = existing.withColumn("_rank", F.lit(0)).unionByName(new.withColumn("_rank", F.lit(1)), allowMissingColumns=True)
    return keep_last(both, list(keys), ["_rank"]).drop("_rank")


def upsert(spark: SparkSession, path: str, new: DataFrame, keys: Sequence[str]) -> str:
    """Idempotent upsert into the newest version under ``path``; returns the version written.

    For small tables that are no series of bars (those use ``merge_bars``).  Every write makes
    a complete version under a name of its own and publishes it by one rename, which fails if
    another writer has published that version first; readers take the newest version.
    """
    current = latest_version(spark, path)
    merged = new if current is None else upserted(spark.read.parquet(current), new, keys)
    number = 0 if current is None else int(current.rsplit("v=", 1)[1]) + 1
    target, draft = f"{path}/v={number:08d}", f"{path}/_draft-{uuid.uuid4().hex}"
    keep_last(merged.withColumn("_one", F.lit(1)), list(keys), ["_one"]).drop("_one").write.parquet(draft)
    folder = spark._jvm.org.apache.hadoop.fs.Path
    fs = folder(draft).getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.exists(folder(target)) or not fs.rename(folder(draft), folder(target)):
        fs.delete(folder(draft), True)
        raise RuntimeError(f"{target} was published by another writer; repeat the upsert")
    return target


def latest_version(spark: SparkSession, path: str) -> str | None:
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(conf)
    if not fs.exists(root):
        return None
    done = [s.getPath().toString() for s in fs.listStatus(root)
            if s.getPath().getName().startswith("v=") and fs.exists(jvm.org.apache.hadoop.fs.Path(s.getPath(), "_SUCCESS"))]
    return max(done) if done else None


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def write_json(df: DataFrame, path: str) -> None:
    """JSON lines; nested structs and maps keep their shape."""
    df.write.mode("overwrite").json(path)


def append_json(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)
