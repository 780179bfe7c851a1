"""Winnowing against a plain loop over code points."""

import random

import pytest
from pyspark.sql import functions as F

from seriesmill.llm import winnow


def code_table(spark, texts, k):
    """Spark's hash of every run of up to four characters."""
    m = min(k, 4)
    runs = sorted({t[i:i + m] for t in texts for i in range(len(t or "") - m + 1) if t})
    row = F.xxhash64(*[F.element_at("c", j + 1) for j in range(m)])
    rows = spark.createDataFrame([(list(r), r) for r in runs] or [(["x"] * m, "")], "c array<string>, r string").select("r", row).collect()
    return {r[0]: r[1] & (2**64 - 1) for r in rows}


def signed(x):
    return x - 2**64 if x >> 63 else x


def plain(text, code, whole, k, w):
    """Selected (hash, position), by position."""
    if not text:
        return []
    if len(text) < k:
        return [(signed(whole) >> 32, 0)]
    grams = []
    for i in range(len(text) - k + 1):
        h = 0
        m = min(k, 4)
        for j in range(0, k, m):
            h = ((h << m) ^ code[text[i + j:i + j + m]]) & (2**64 - 1)
        grams.append(signed(h) >> 31)
    chosen = set()
    for s in range(max(1, len(grams) - w + 1)):
        part = grams[s:s + w]
        least = min(part)
        at = s + max(i for i, h in enumerate(part) if h == least)
        chosen.add((grams[at] >> 1, at))
    return sorted(chosen, key=lambda x: x[1])


TEXTS = ["", "a", "ab" * 40, "a" * 200, "é😀z" * 30, "ABC" * 5, None]


def texts():
    rng = random.Random(5)
    return TEXTS + ["".join(rng.choices("ab cdé😀", k=rng.randint(0, 400))) for _ in range(40)]


@pytest.mark.parametrize("k,w", [(8, 32), (16, 8), (1, 4), (4, 1), (2, 2), (4, 16)])
def test_selection_equals_plain_loop(spark, k, w):
    rows = list(enumerate(texts()))
    code = code_table(spark, [t for _, t in rows], k)
    df = spark.createDataFrame(rows, "i int, t string").select(
        "i", "t", winnow.winnowed(F.col("t"), k, w).alias("p"), F.xxhash64("t").alias("whole"))
    for r in df.select("t", "whole", winnow.hashes(F.col("p")).alias("h"), winnow.positions(F.col("p")).alias("p")).collect():
        assert list(zip(r["h"], r["p"])) == plain(r["t"], code, r["whole"] & (2**64 - 1), k, w), r["t"]


def test_amended_equals_whole(spark):
    rng, rows = random.Random(9), []
    for i, t in enumerate(texts()):
        t, tail = t or "", "".join(rng.choices("ab cdé", k=rng.randint(0, 120)))
        same = rng.randint(0, len(t))
        rows.append((i, t, same, t[:same] + tail))
    df = spark.createDataFrame(rows, "i int, old string, same int, new string").withColumn("p", winnow.winnowed(F.col("old")))
    kept = winnow.hashes(F.filter("p", lambda x: F.lit(winnow.LAST) - x.bitwiseAND(F.lit(winnow.LAST).cast("long"))
                                  <= winnow.settled_by(F.col("same"))))
    out = df.select("i", winnow.amended(kept, F.col("same"), F.col("new")).alias("a"),
                    winnow.hashes(winnow.winnowed(F.col("new"))).alias("b")).collect()
    assert all(r["a"] == r["b"] for r in out)


def test_common_stretch_is_found(spark):
    """Texts that share w + k - 1 code points share a hash."""
    rng = random.Random(2)
    rows = []
    for _ in range(30):
        common = "".join(rng.choices("abcdefgh ", k=winnow.K + winnow.WINDOW - 1))
        rows.append(tuple("".join(rng.choices("ijklmnop ", k=rng.randint(0, 90))) + common
                          + "".join(rng.choices("ijklmnop ", k=rng.randint(0, 90))) for _ in range(2)))
    df = spark.createDataFrame(rows, "a string, b string")
    both = F.size(F.array_intersect(winnow.hashes(winnow.winnowed(F.col("a"))), winnow.hashes(winnow.winnowed(F.col("b")))))
    assert df.select(F.min(both)).first()[0] >= 1


def test_likeness_and_bad_parameters(spark):
    one = spark.createDataFrame([([], [], [1, 2], [2, 2, 3])], "a array<int>, b array<int>, c array<int>, d array<int>")
    like = winnow.likeness
    assert tuple(one.select(like(F.col("a"), F.col("b")), like(F.col("a"), F.col("c")), like(F.col("c"), F.col("d"))).first()) == (
        1.0, 0.0, pytest.approx(1 / 3))
    with pytest.raises(ValueError):
        winnow.winnowed(F.lit("x"), 12, 32)


def test_a_carried_fingerprint_has_six_bytes_a_gram_and_loses_nothing(spark):
    from pyspark.sql import functions as F

    texts = ["", "a", "short text", "".join(chr(97 + k * k % 23) for k in range(32_768)), "".join(chr(97 + k * 7 % 25 + k % 2) for k in range(40_001))]
    df = spark.createDataFrame([(t,) for t in texts], "text string").withColumns({"n": F.char_length("text"), "packed": winnow.winnowed(F.col("text"))})
    half = F.floor(F.col("n") / 2).cast("int")
    got = df.withColumn("c", winnow.carried(F.col("packed"), F.col("n"), half)).select(
        "n", "c.*", winnow.places(F.col("c")).alias("p"), winnow.positions(F.col("packed")).alias("want_p"),
        winnow.hashes(F.col("packed")).alias("want_h"), winnow.settled_by(half).alias("last"))
    assert [f.dataType.simpleString() for f in got.schema.fields[1:3]] == ["array<int>", "array<smallint>"]
    for r in got.collect():
        assert r.p == r.want_p and r.h == r.want_h and r.stay == sum(p <= r["last"] for p in r.want_p)
        assert (r.near is None) == (r.n > 32_768) and (r.far is None) == (r.n <= 32_768)


def test_no_pass_over_the_characters_adds_to_an_index_or_copies_its_array(spark):
    plan = spark.createDataFrame([("a",)], "t string").select(winnow.winnowed(F.col("t")).alias("w"))._jdf.queryExecution().optimizedPlan().toString()
    # two to double the grams, one for positions, five for windows; only the codes of four characters go by index
    assert (plan.count("zip_with("), plan.count("transform(")) == (8, 1)
