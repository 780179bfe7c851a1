"""Feistel shards: bijection, laws and edge cases."""

import pytest
from pyspark.sql import functions as F

from seriesmill.llm import shards


@pytest.mark.parametrize("n", [1, 2, 3, 5, 16, 17, 99, 1000, 10_007])
def test_permutation_is_a_bijection(spark, n):
    got = [r[0] for r in spark.range(n).select(shards.permuted(F.col("id"), n, 17)).collect()]
    assert sorted(got) == list(range(n))
    if n > 50:
        assert got != list(range(n)) and got != [r[0] for r in spark.range(n).select(shards.permuted(F.col("id"), n, 18)).collect()]


def test_neighbours_are_torn_apart(spark):
    n = 10_000
    got = [r[0] for r in spark.range(n).select(shards.permuted(F.col("id"), n, 1)).collect()]
    assert sum(abs(a - b) < n / 20 for a, b in zip(got, got[1:])) < 0.15 * n


def test_counts_slots_and_reruns(spark):
    rows = [(None, "a"), (None, "a"), (3, None), (3, "b"), *((i, "x" * (i % 7)) for i in range(500))]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumns({"shard": F.lit("old"), "place": F.lit(1)})
    order = [F.col("doc_id"), F.col("text")]
    got = shards.sharded(df, order, 40).collect()
    slots = {}
    for r in got:
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert len(got) == len(rows) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    sizes = [len(s) for s in slots.values()]
    assert max(sizes) - min(sizes) <= 1 and len(slots) == 40
    again = shards.sharded(df.repartition(7), order, 40).collect()
    key = lambda r: (str(r["doc_id"]), str(r["text"]), r["shard"], r["slot"])
    assert sorted(map(key, got)) == sorted(map(key, again))


def test_few_rows_and_none(spark):
    df = spark.createDataFrame([(1,), (2,)], "doc_id bigint")
    got = shards.sharded(df, [F.col("doc_id")], 40).collect()
    assert sorted((r["shard"], r["slot"]) for r in got) == [(0, 0), (1, 0)]
    assert shards.sharded(df.where("false"), [F.col("doc_id")], 40).count() == 0


def test_written_by_slot(spark, tmp_path):
    df = spark.range(100).withColumnRenamed("id", "doc_id")
    shards.write_shards(shards.sharded(df, [F.col("doc_id")], 5), str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).groupBy("shard").count().select("count").distinct().collect() == [(20,)]
