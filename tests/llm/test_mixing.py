"""Mix: targets against a loop, counts, positions and edge cases."""

import random

import pytest
from pyspark.sql import functions as F

from seriesmill.llm import mixing
from seriesmill.llm.mixing import Schedule

CURVES = (Schedule(((0.0, 4.5), (1.0, 1.5))), Schedule(((0.0, 1.0), (1.0, 1.0))), Schedule(((0.0, 0.0), (0.5, 2.0), (1.0, 6.0))))


def targets(sizes, weights, share, cap):
    """Share by weight; what a full source cannot take is shared again."""
    budget, full = share * sum(sizes), [False] * len(sizes)
    while True:
        rest = budget - sum(cap * s for s, f in zip(sizes, full) if f)
        total = sum(w for w, f in zip(weights, full) if not f)
        out = [cap * s if f else rest * w / total for s, w, f in zip(sizes, weights, full)]
        over = [f or o > cap * s for s, o, f in zip(sizes, out, full)]
        if over == full:
            return out
        full = over


def plan(spark, rows, **more):
    df = spark.createDataFrame(rows, "doc_id bigint, source string, size bigint").withColumns({"target": F.lit(0), "near": F.lit(1)}).drop("target")
    return mixing.planned(df, F.xxhash64("doc_id", "size"), [F.col("doc_id"), F.col("size")], CURVES, 1.5, 2, **more)


def test_targets_and_takings(spark):
    rng = random.Random(4)
    rows = [(i, s, int(rng.lognormvariate(4, 1))) for s, n in (("a", 300), ("b", 20), ("Z", 40), (None, 60), ("é", 5)) for i in range(n)]
    got = plan(spark, rows).collect()
    assert len(got) == len(rows)
    names = ["Z", "a", "b", "é", None]
    sizes = [sum(r[2] for r in rows if r[1] == s) for s in names]
    want = dict(zip(names, targets(sizes, [c.integral() for c in CURVES] + [c.integral() for c in CURVES[:2]], 1.5, 2)))
    for s, size in zip(names, sizes):
        mine = [r for r in got if r["source"] == s]
        assert {r["source_size"] for r in mine} == {size}
        assert mine[0]["target"] == pytest.approx(want[s], rel=1e-9)
        taken = sum(r["copies"] * r["size"] for r in mine)
        assert abs(taken - want[s]) <= max(r["size"] for r in mine) / 2
        assert max(r["copies"] for r in mine) <= 2
    assert all(len(r["positions"]) == r["copies"] and all(0 <= p <= 1 for p in r["positions"]) for r in got)


@pytest.mark.parametrize("curve", CURVES)
def test_time_inverts_the_integral(spark, curve):
    shares = [k / 200 for k in range(201)]
    df = spark.createDataFrame([(s,) for s in shares], "s double")
    for share, t in zip(shares, (r[0] for r in df.select(curve.time_at(F.col("s"))).collect())):
        area = 0.0
        for (t0, w0), (t1, w1) in zip(curve.knots, curve.knots[1:]):
            x = min(max(t - t0, 0.0), t1 - t0)
            area += w0 * x + (w1 - w0) / (t1 - t0) * x * x / 2
        assert area == pytest.approx(share * curve.integral(), abs=1e-9)


def test_training_order_follows_the_schedule(spark):
    rows = [(i, s, 10) for s in ("a", "b", "c") for i in range(400)]
    order = mixing.in_training_order(plan(spark, rows), ["doc_id"])
    got = order.where("position < 0.25").groupBy("source").count().collect()
    early = {r["source"]: r["count"] for r in got}
    assert early["a"] > 1.1 * order.where("source = 'a'").count() / 4 and early["c"] < 0.6 * order.where("source = 'c'").count() / 4


def test_edge_cases(spark):
    rows = [(1, "a", None), (2, "a", 5), (2, "a", 5), (None, None, 3), (4, "empty", 0), (5, "b", -3), (6, "b", 7)]
    got = plan(spark, rows).collect()
    assert len(got) == len(rows)
    assert [r["copies"] for r in got if r["source"] == "empty"] == [1]
    assert plan(spark, rows).where("false").count() == 0
    empty = spark.createDataFrame([], "doc_id bigint, source string, size bigint")
    assert mixing.planned(empty, F.xxhash64("doc_id"), [F.col("doc_id")], CURVES, 1.5, 2).count() == 0
    with pytest.raises(ValueError):
        Schedule(((0.0, 1.0), (0.9, 1.0)))
