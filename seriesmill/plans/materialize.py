"""Cutting lineage and deciding on broadcasts from measured sizes."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, functions as F

from seriesmill.session import ensure_checkpoint_dir

#: A summary is broadcast only below both limits: counted rows, and bytes of its files.
BROADCAST_ROWS, BROADCAST_BYTES = 200_000, 8_000_000


def settle(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and continue from there.

    Used where a result is read several times or its plan would otherwise be repeated; a lost
    executor then re-reads files instead of recomputing the chain, and a reader of few
    columns reads those only.
    """
    path = f"{ensure_checkpoint_dir(df.sparkSession)}/settled-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stored_bytes(settled: DataFrame) -> int:
    """Size of the files of a settled table."""
    spark = settled.sparkSession
    for file in settled.inputFiles()[:1]:
        folder = spark._jvm.org.apache.hadoop.fs.Path(file).getParent()
        return folder.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(folder).getLength()
    return 0


def sized(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Settle a per-group summary and mark it for broadcast only if it is measured small.

    Beyond ``max_rows`` or ``max_bytes`` the plain (AQE skew-aware) shuffle join is used instead.
    """
    done = settle(df)
    small = stored_bytes(done) <= max_bytes and done.limit(max_rows + 1).count() <= max_rows
    return F.broadcast(done) if small else done


def with_scalars(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Add the values of a one-row summary as constants (one row reaches the driver)."""
    row = one_row.first()
    types = {f.name: f.dataType for f in one_row.schema.fields}
    return df.withColumns({n: F.lit(row[n] if row else None).cast(t) for n, t in types.items()})
