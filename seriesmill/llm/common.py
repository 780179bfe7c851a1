"""Written tables, row numbers and column names shared by the operators of this subpackage."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterable, Sequence
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from seriesmill.plans.materialize import stored_bytes
from seriesmill.session import ensure_checkpoint_dir, prepare

#: Rows per Arrow batch: long texts must not meet in one batch by the ten thousand.
ARROW_ROWS = 512
#: A table is marked for broadcast only while its measured rows and bytes stay below these.
BROADCAST_ROWS, BROADCAST_BYTES = 250_000, 10_000_000


def ready(spark: SparkSession) -> SparkSession:
    """The session with UTC, a shared checkpoint folder and small Arrow batches."""
    spark = prepare(spark)
    root, env = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):  # Python workers find this package as the driver does
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [root, env.get("PYTHONPATH")]))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    return spark


def documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return ready(spark).read.parquet(f"{sf_dir}/documents.parquet").select(*columns)


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder that driver and executors share."""
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def settle(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and go on from the files.

    Cuts the lineage and pins nondeterministic columns: a lost executor re-reads files.
    """
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def forget(*tables: DataFrame) -> None:
    """Remove settled tables that no later plan reads."""
    for table in tables:
        spark = table.sparkSession
        for file in table.inputFiles()[:1]:
            folder = spark._jvm.org.apache.hadoop.fs.Path(file).getParent()
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def bounded(df: DataFrame, row_bytes: int) -> DataFrame:
    """Mark a settled table for broadcast if its counted rows (of about ``row_bytes``) are few."""
    most = min(BROADCAST_ROWS, BROADCAST_BYTES // row_bytes)
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def measured(df: DataFrame) -> DataFrame:
    """Mark a settled table for broadcast if its rows are counted and its files measured small.

    Files are compressed, so they may take a quarter of what a broadcast may take.
    """
    small = stored_bytes(df) * 4 <= BROADCAST_BYTES and df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    return F.broadcast(df) if small else df


def unused(taken: Iterable[str], *names: str) -> list[str]:
    """The names, each with underscores in front until no column has it."""
    seen, out = {t.lower() for t in taken}, []
    for name in names:
        while name.lower() in seen:
            name = "_" + name
        seen.add(name.lower())
        out.append(name)
    return out


def numbered(df: DataFrame, order: Sequence[Column], number: str) -> tuple[DataFrame, int]:
    """Add global row numbers from 0 in ``order``; also returns the number of rows.

    The rows are range partitioned and sorted, each partition numbers its own rows, and one
    count per partition (all that reaches the driver) carries the numbers on.  The local
    numbers are written down with the rows, so a repeated task cannot change them.
    """
    part, local, start = unused(df.columns, "part", "local", "start")
    placed = settle(
        df.repartitionByRange(*order).sortWithinPartitions(*order).withColumns({
            part: F.spark_partition_id(),
            local: F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))}), "numbered")
    sizes = sorted((r[0], r[1]) for r in placed.groupBy(part).count().collect())
    starts, total = [], 0
    for which, size in sizes:
        starts.append((which, total))
        total += size
    table = df.sparkSession.createDataFrame(starts, f"`{part}` int, `{start}` bigint")
    return (placed.join(F.broadcast(table), part)
            .select(*df.columns, (F.col(start) + F.col(local)).alias(number))), total


def running_before(df: DataFrame, group: str, key: Column, ties: Sequence[Column], value: str, into: str,
                   rows: DataFrame, row_group: str, buckets: str) -> DataFrame:
    """Total of ``value`` over the earlier rows of the same ``group`` in the order of a hash ``key``.

    ``rows`` has one row per ``row_group`` with the number of ``buckets`` its rows are dealt to.  The
    64-bit ``key`` is spread evenly, so a bucket is a slice of the order with few rows however
    hot the group is; a table with one row per bucket carries the totals on.
    """
    slot, at, carry, total = unused([*df.columns, buckets, into], "slot", "key", "carry", "total")
    share = F.shiftrightunsigned(key, 11).cast("double") / F.lit(float(1 << 53))
    dealt = (df.join(rows, F.col(group).eqNullSafe(F.col(row_group)))
             .withColumns({at: F.shiftrightunsigned(key, 1), slot: F.floor(share * F.col(buckets)).cast("long")}))
    sums = dealt.groupBy(group, slot).agg(F.sum(value).alias(total))
    earlier = Window.partitionBy(group).orderBy(slot).rowsBetween(Window.unboundedPreceding, -1)
    carried = sums.select(F.col(group).alias(f"{carry}_g"), F.col(slot).alias(f"{carry}_s"),
                          F.coalesce(F.sum(total).over(earlier), F.lit(0)).alias(carry))
    inside = Window.partitionBy(group, slot).orderBy(at, *ties).rowsBetween(Window.unboundedPreceding, -1)
    return (dealt.withColumn(into, F.coalesce(F.sum(value).over(inside), F.lit(0)))
            .join(carried, F.col(group).eqNullSafe(F.col(f"{carry}_g")) & (F.col(slot) == F.col(f"{carry}_s")))
            .withColumn(into, F.col(into) + F.col(carry))
            .drop(slot, at, carry, f"{carry}_g", f"{carry}_s"))
