"""Exact deduplication against a persistent digest index.

The index is a Parquet table bucketed and sorted by digest.  A batch is reduced to one row
per digest, the digests the index lacks are found by a sort-merge anti-join (the index side
is read as it lies, without a shuffle) and appended.  Only DataFrame operations.

Defined results
    null text counts as empty; texts are equal when identical after lower-casing A-Z only;
    of equal texts the row with the largest id stays (a null id only if all ids are null);
    of repeated rows with that id one stays; a text the index knows keeps the index's id;
    an empty batch leaves the index as it is; further columns are passed over.
    Repeating a batch gives the same decisions: its own digests are never appended twice.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from seriesmill.llm.common import settle, shared_path, unused

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def digest_of(text: Column) -> Column:
    """SHA-256 of the normalised text as 32 bytes."""
    return F.unhex(F.sha2(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), 256))


@dataclass
class DigestIndex:
    """Table ``name`` at ``path`` with columns ``digest`` and ``keep_id``."""

    spark: SparkSession
    name: str
    path: str
    buckets: int = 16

    def create(self) -> DigestIndex:
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS `{self.name}` (digest BINARY, keep_id BIGINT) USING parquet "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS LOCATION '{self.path}'")
        return self

    def rows(self) -> DataFrame:
        return self.spark.table(self.name)

    def unknown(self, batch: DataFrame) -> DataFrame:
        """The rows of ``batch`` (one per digest) whose digest the index lacks."""
        return batch.hint("merge").join(self.rows(), "digest", "left_anti")

    def append(self, batch: DataFrame) -> None:
        """One writer per bucket, so each batch adds one file to a bucket."""
        batch.select("digest", "keep_id").repartition(self.buckets, "digest").write.insertInto(self.name)


def new_index(spark: SparkSession, buckets: int = 16) -> DigestIndex:
    """An empty index in the shared folder."""
    path = shared_path(spark, "digests")
    return DigestIndex(spark, "digests_" + path.rsplit("-", 1)[1], path, buckets).create()


def decide(docs: DataFrame, index: DigestIndex, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Deduplicate a batch and append its new digests to the index.

    Returns one row per row of ``docs``: ``doc_id``, ``digest``, ``keep_id`` (the id that stays),
    ``group_size`` (rows of the batch with this text), ``kept``.
    """
    # equal (text, id) pairs become one row with their number, before anything is shuffled
    own = settle(docs.select(F.col(doc_id).alias("doc_id"), digest_of(F.col(text)).alias("digest"))
                 .groupBy("digest", "doc_id").agg(F.count(F.lit(1)).alias("times")), "digests-batch")
    groups = own.groupBy("digest").agg(F.max("doc_id").alias("keep_id"), F.sum("times").alias("group_size"))
    index.append(index.unknown(groups))
    known = groups.select("digest", "group_size").hint("merge").join(index.rows(), "digest")
    # a hot text is a hot key on the side of the rows only: AQE splits such a join
    joined = own.join(known.withColumnRenamed("digest", "known"), F.col("digest") == F.col("known"))
    return (joined.select("doc_id", "digest", "keep_id", "group_size",
                          F.explode(F.sequence(F.lit(1).cast("long"), F.col("times"))).alias("copy"))
            .select("doc_id", "digest", "keep_id", "group_size",
                    (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)).alias("kept")))


def deduplicated(docs: DataFrame, index: DigestIndex, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    Rows meet their decision by digest and id, which spreads the copies of a hot text.
    """
    stay, stay_id = unused(docs.columns, "stay_digest", "stay_id")
    kept = decide(docs, index, doc_id, text).where("kept").select(
        F.col("digest").alias(stay), F.col("doc_id").alias(stay_id))
    (mine,) = unused([*docs.columns, stay, stay_id], "digest")
    joined = docs.withColumn(mine, digest_of(F.col(text))).join(
        kept, (F.col(mine) == F.col(stay)) & F.col(doc_id).eqNullSafe(F.col(stay_id)))
    # repeated rows with the same id: one stays
    return joined.dropDuplicates([mine, doc_id]).select(*docs.columns)
