"""SimHash groups against brute force."""

import random
import re

import numpy as np
import pandas as pd
import pytest
import xxhash
from pyspark.sql import functions as F

from seriesmill.llm import simhash
from seriesmill.llm.components import components

TEXTS = [None, "", " \n\t", "a", "a b", "A B c", "É B c D", "x  y\x0bz w", "one two three four five " * 50, "w " * 70_000]


def plain_print(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    grams = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("text", TEXTS)
def test_fingerprint(text):
    assert simhash.fingerprint(text) == plain_print(text)


def plain_components(prints):
    near = np.bitwise_count(prints[:, None] ^ prints[None, :]) <= 2
    label = np.arange(len(prints))
    while True:
        low = np.array([label[row].min() for row in near])
        low = low[low]
        if (low == label).all():
            return label
        label = low


def same_partition(prints, label, roots):
    seen = {}
    for value, mine in zip(prints.view(np.int64), label):
        seen.setdefault(int(mine), set()).add(int(roots.get(value, value)))
    assert all(len(v) == 1 for v in seen.values())
    assert len({next(iter(v)) for v in seen.values()}) == len(seen)


@pytest.mark.parametrize("crowd", [1024, 256])
def test_links_against_all_pairs(spark, crowd):
    """Random prints, chains of small steps, and a crowd that agrees in most bits (refined keys)."""
    rng = np.random.default_rng(3)
    now = rng.integers(0, 1 << 64, 60, dtype=np.uint64)
    bit = lambda n: np.uint64(1) << rng.integers(0, 64, n, dtype=np.uint64)
    for _ in range(5):
        now = np.concatenate([now, now ^ bit(len(now)) ^ np.where(rng.random(len(now)) < 0.6, bit(len(now)), np.uint64(0))])
    crowded = np.uint64(0xABCD000000000000) + rng.integers(0, 1 << 20, 1500, dtype=np.uint64)
    prints = np.unique(np.concatenate([now, crowded, np.zeros(1, np.uint64)]))
    df = spark.createDataFrame(pd.DataFrame({"print": prints.view(np.int64)}))
    tied = components(simhash.links(df, crowd)).toPandas()
    same_partition(prints, plain_components(prints), dict(zip(tied.node, tied.root)))


def test_coordinates_bound_the_distance():
    rng = np.random.default_rng(1)
    a, b = rng.integers(0, 1 << 64, (2, 500), dtype=np.uint64)
    apart = np.abs(simhash.distances(a) - simhash.distances(b)).max(axis=1)
    assert (apart <= np.bitwise_count(a ^ b)).all()


def test_groups_of_texts(spark):
    rng = random.Random(1)
    words = ["".join(rng.choices("abcdef", k=5)) for _ in range(400)]
    base = [" ".join(rng.choices(words, k=300)) for _ in range(12)]
    rows = [(i, t) for i, t in enumerate(base)]
    rows += [(100 + i, t.upper()) for i, t in enumerate(base)] + [(200 + i, t + " tail") for i, t in enumerate(base)]
    rows += [(None, base[0]), (7, base[0]), (7, base[0]), (900, None), (901, ""), (902, "  ")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumns({"print": F.lit(1), "root": F.lit(2)})
    got = simhash.near_groups(df).collect()
    assert len(got) == len(rows)
    prints = np.array([plain_print(t) for _, t in rows], dtype=np.uint64)
    label = plain_components(prints)
    want = {}
    for (i, _), k in zip(rows, label):
        if i is not None:
            want[k] = min(i, want.get(k, i))
    left = sorted((str(i), int(p), want[k]) for (i, _), p, k in zip(rows, prints, label))
    assert sorted((str(r["doc_id"]), r["print"] & (2**64 - 1), r["component_id"]) for r in got) == left
    assert simhash.near_groups(df.where("false")).count() == 0


def test_one_of_each_group_stays(spark):
    rows = [(3, "a b c d", 1), (9, "A B c d", 2), (4, "other words here now", 3), (4, "other words here now", 3), (None, "a b c d", 4),
            (None, "no id at all", 5), (12, None, 6), (11, " ", 7)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, mark int")
    got = simhash.representatives(df)
    assert got.columns == df.columns
    assert sorted((str(r["doc_id"]), r["mark"]) for r in got.collect()) == [("11", 7), ("3", 1), ("4", 3), ("None", 5)]
    assert simhash.representatives(df.where("false")).count() == 0


def test_components_of_long_chain_and_hub(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 300)] + [(5, 5), (7, None), (3, 4)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert all(got[i] == 0 for i in range(201)) and all(got[1000 + i] == 1000 for i in range(300)) and len(got) == 501
