"""Digest index: decisions, increments, repeats and edge cases."""

import hashlib
from collections import Counter

from pyspark.sql import functions as F

from seriesmill.llm import digests

ROWS = [(1, "Abc"), (2, "aBC"), (3, None), (4, ""), (5, "É"), (6, "é"), (None, "x"), (None, "x"), (7, "abc "), (8, "y" * 300_000),
        (9, "Y" * 300_000), (9, "y" * 300_000), (10, "z"), (10, "z")]


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


def plain(rows):
    out, groups = Counter(), {}
    for i, t in rows:
        groups.setdefault(lower(t), []).append(i)
    for t, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        done = False
        for i in ids:
            kept = i == keep and not done
            done |= kept
            out[i, keep, len(ids), kept, hashlib.sha256(t.encode()).hexdigest()] += 1
    return out


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, text string").withColumns({"digest": F.lit(1), "keep_id": F.lit("clash")})


def decided(df, index):
    got = digests.decide(df, index).withColumn("digest", F.lower(F.hex("digest"))).collect()
    return Counter((r["doc_id"], r["keep_id"], r["group_size"], r["kept"], r["digest"]) for r in got)


def test_against_plain_loop(spark):
    assert decided(frame(spark, ROWS), digests.new_index(spark, 4)) == plain(ROWS)


def test_batches_meet_the_index_and_repeat(spark):
    index = digests.new_index(spark, 4)
    digests.decide(frame(spark, ROWS[:6]), index).collect()
    second = {(r["doc_id"], r["keep_id"], r["kept"]) for r in digests.decide(frame(spark, [(20, "abc"), (21, "new")]), index).collect()}
    assert second == {(20, 2, False), (21, 21, True)}
    size = index.rows().count()
    again = {(r["doc_id"], r["keep_id"], r["kept"]) for r in digests.decide(frame(spark, [(20, "abc"), (21, "new")]), index).collect()}
    assert again == second and index.rows().count() == size


def test_index_side_is_not_shuffled(spark):
    index = digests.new_index(spark, 4)
    batch = spark.createDataFrame([(bytes(32), 1)], "digest binary, keep_id bigint")
    index.append(batch)
    plan = index.unknown(batch)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and plan.count("Exchange hashpartitioning") == 1


def test_survivors_keep_all_columns(spark):
    df = frame(spark, ROWS)
    got = digests.deduplicated(df, digests.new_index(spark, 4))
    assert got.columns == df.columns
    assert Counter(lower(r["text"]) for r in got.collect()) == Counter({lower(t): 1 for _, t in ROWS})


def test_empty_table(spark):
    df = frame(spark, ROWS).where("false")
    assert digests.decide(df, digests.new_index(spark, 4)).count() == 0
    assert digests.deduplicated(df, digests.new_index(spark, 4)).count() == 0
