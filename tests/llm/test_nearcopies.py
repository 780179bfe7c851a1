"""Near copies against exact Jaccard similarities of all pairs."""

import random

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from seriesmill.llm import nearcopies
from seriesmill.llm.common import settle
from seriesmill.llm.components import components


def plain_set(text):
    words = (text or "").encode().lower().split()
    return frozenset(b" ".join(words[i:i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def alike(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def plain_groups(texts):
    sets = [plain_set(t) for t in texts]
    near = np.array([[alike(a, b) >= 0.8 for b in sets] for a in sets])
    label = np.arange(len(sets))
    while True:
        low = np.array([label[row].min() for row in near])
        if (low[low] == label).all():
            return label
        label = low[low]


def edited(rng, text, least, most):
    """A copy with scattered one-word edits whose similarity is in the given range."""
    words, whole = text.split(), plain_set(text)
    for _ in range(10_000):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10**9)}"
        now = alike(whole, plain_set(" ".join(words)))
        if now < most:
            if now >= least:
                return " ".join(words)
            words = text.split()
    raise AssertionError("no such edit")


def planted(seed=1):
    rng = random.Random(seed)
    words = ["".join(rng.choices("abcdefgh", k=6)) for _ in range(3000)]
    texts = [" ".join(rng.choices(words, k=rng.choice([60, 200, 600]))) for _ in range(60)]
    bands = [(0.8, 0.82), (0.8, 0.85), (0.85, 0.9), (0.9, 0.95), (0.95, 1.0), (0.7, 0.78)]
    copies = [edited(rng, t, *bands[k % len(bands)]) for k, t in enumerate(texts) if len(t.split()) > 60 or k % 6 in (2, 5)]
    chain = [" ".join(rng.choices(words, k=300))]
    for _ in range(6):
        chain.append(edited(rng, chain[-1], 0.8, 0.85))
    hot = " ".join(rng.choices(words, k=120))
    crowd = [edited(rng, hot, 0.85, 0.95) for _ in range(120)]
    mixed = [hot + " " + " ".join(rng.choices(words, k=60)) for _ in range(20)]  # one passage, else unlike
    return [*texts, *copies, *chain, *crowd, *mixed, None, "", " \n", "a b", "A  b", "a b c"]


def test_planted_copies_are_found(spark):
    texts = planted()
    ids = list(range(len(texts)))
    random.Random(2).shuffle(ids)
    df = spark.createDataFrame(list(zip(ids, texts)), "doc_id bigint, text string").withColumns({"node": F.lit(1), "of": F.lit(2)})
    want = {}
    label = plain_groups(texts)
    for i, k in zip(ids, label):
        want[k] = min(i, want.get(k, i))
    got = {r["doc_id"]: r["component_id"] for r in nearcopies.groups(df).collect()}
    assert got == {i: want[k] for i, k in zip(ids, label)}
    left = corpus_pipeline.near_dedup(spark, df, "")
    assert left.columns == df.columns and sorted(r["doc_id"] for r in left.collect()) == sorted(want.values())
    assert nearcopies.groups(df.where("false")).count() == 0


def _rows(spark, texts):
    """Nodes and their rows under shared keys, every node its own component."""
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(4)
    nodes = settle(nearcopies.signatures(df).dropDuplicates(["node"]), "test-nodes")
    return nodes, settle(nearcopies.shared_rows(nodes), "test-rows")


def test_pairs_under_a_hot_key_of_unlike_texts_grow_with_the_rows(spark):
    """Texts that share a passage of three quarters of their words: all below 0.8, under few keys."""
    rng = random.Random(3)
    passage = " ".join(f"p{k}" for k in range(60))
    seen = []
    for n in (150, 600):
        texts = [passage + " " + " ".join(f"u{rng.randrange(10**9)}" for _ in range(18)) for _ in range(n)]
        nodes, rows = _rows(spark, texts)
        pairs = nearcopies.crossing_pairs(rows.withColumn("root", F.col("node")), nodes)
        most = rows.groupBy("key").count().agg(F.max("count")).first()[0]
        assert most > nearcopies.FEW * 2  # the keys are hot
        seen.append(pairs.count() / n)
    assert seen[1] < 3 * seen[0] and seen[1] < 600 / 4  # a square would be four times as many per text


def test_a_hot_group_of_copies_needs_few_pairs_a_text(spark):
    rng = random.Random(4)
    hot = " ".join(f"h{k}" for k in range(150))
    texts = list({edited(rng, hot, 0.85, 0.98) for _ in range(300)})
    nodes, rows = _rows(spark, texts)
    rows = rows.withColumn("root", F.col("node"))
    assert nearcopies.nearest(rows, nodes).count() <= len(texts)
    looked = []

    def sets(wanted, nodes):
        looked.append(wanted.count())
        df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
        return nearcopies.sets_of(wanted, nodes, df, "doc_id", "text")

    tied = components(nearcopies.links(settle(nearcopies.signatures(spark.createDataFrame(
        list(enumerate(texts)), "doc_id bigint, text string")), "test-signed"), sets))
    assert tied.select("root").distinct().count() == 1 and tied.count() == len(texts)
    assert looked[0] <= len(texts) and sum(looked) < 2.5 * len(texts)


def test_recall_by_similarity_among_unlike_texts_with_a_shared_passage(spark):
    """Refined keys still find the pairs: each text here shares a passage with all and has one copy."""
    rng = random.Random(6)
    passage = " ".join(f"p{k}" for k in range(60))
    bands = [(0.8, 0.85), (0.85, 0.9), (0.9, 0.95)]
    texts, want = [], []
    for k in range(240):
        texts.append(passage + " " + " ".join(f"u{rng.randrange(10**9)}" for _ in range(20)))
        texts.append(edited(rng, texts[-1], *bands[k % 3]))
        want.append((len(texts) - 2, len(texts) - 1, k % 3))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(4)
    root = {r["doc_id"]: r["component_id"] for r in nearcopies.groups(df).collect()}
    for band in range(3):
        found = [root[a] == root[b] for a, b, k in want if k == band]
        assert sum(found) / len(found) >= 0.97
