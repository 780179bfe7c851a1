"""Importance resampling: n-grams, ratios, the draw and held-out accuracy."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from seriesmill.llm import importance


def plain_grams(text):
    """(kind, order, gram) in a plain loop, as tuples instead of hashes."""
    tokens, now, group = [], "", 0
    for c in [*text, " "]:
        kind = 0 if c.isspace() else 1 if c.isalpha() or c.isdigit() else 2
        if kind != group and now:
            tokens.append((group, now))
            now = ""
        group = kind
        now = now + c if kind else ""
    forms, last = [], None
    for group, t in tokens:
        if group == 2:
            forms.append(t)
            continue
        low = t.lower()
        form = ("lower" if t.islower() and t.isalpha() else "number" if t.isdigit() else
                "capital" if t[0].isupper() and (t[1:] == "" or (t[1:].islower() and t[1:].isalpha())) else
                "upper" if t.isupper() and t.isalpha() else "mixed")
        forms.append("again" if low == last else form)
        last = low
    words = [t.lower() for _, t in tokens]
    return ([("w", n, tuple(words[i:i + n])) for n in (1, 2) for i in range(len(words) - n + 1)]
            + [("f", n, tuple(forms[i:i + n])) for n in (1, 2, 3) for i in range(len(forms) - n + 1)])


def test_ngrams_are_those_of_a_plain_loop():
    """The same grams fall together, over all texts and nowhere else (up to hash collisions)."""
    texts = ["Ab cd*** CD cd  cd 12 x9!", "ab, AB CD", "", "é É é", "..", " a\n", "a"]
    owner, bucket = importance.ngrams(texts)
    names = {}
    for k, t in enumerate(texts):
        mine = sorted(bucket[owner == k])
        want = plain_grams(t)
        assert len(mine) == len(want), t
        for g in want:
            names.setdefault(g, set()).add(k)
    for g, ks in names.items():  # a gram of two texts must give them a common bucket
        common = set.intersection(*(set(bucket[owner == k]) for k in ks))
        assert common
    whole, alone = importance.ngrams(["x y", "Zz***"]), importance.ngrams(["Zz***"])
    assert sorted(whole[1][whole[0] == 1]) == sorted(alone[1])


def corpus(n=900, seed=1):
    rng = random.Random(seed)
    words = ["".join(rng.choices("abcdefgh", k=rng.randint(2, 7))) for _ in range(300)]
    rows = []
    for i in range(n):
        text = rng.choices(words, k=rng.randint(20, 200))
        bad = i % 6 == 0
        kind = rng.randint(0, 2)
        if bad:
            text = ([w.upper() + "!!" for w in text] if kind == 0 else [w + rng.choice(["***", "%%%"]) for w in text] if kind == 1 else [text[0]] * len(text))
        rows.append((i, " ".join(text).capitalize() if not bad else " ".join(text), 0 if bad else 1))
    return rows


def test_bad_texts_are_left_out(spark):
    rows = corpus()
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, q) for i, _, q in rows if i % 2], "doc_id bigint, quality int")
    labels = labels.unionByName(spark.createDataFrame([(r[0], r[2]) for r in rows if r[2] == 0][::2], "doc_id bigint, quality int"))
    got = {r["doc_id"]: r["kept"] for r in importance.selected(docs, labels).collect()}
    wrong = sum(got[i] != bool(q) for i, _, q in rows)
    assert len(got) == len(rows) and wrong <= 0.01 * len(rows)
    again = {r["doc_id"]: r["kept"] for r in importance.selected(docs.repartition(5), labels).collect()}
    assert again == got


def test_draw_is_the_k_largest(spark):
    rng = np.random.default_rng(2)
    df = spark.createDataFrame([(i, float(w), i) for i, w in enumerate(rng.normal(0, 2, 400))], "doc_id bigint, log_weight double, mark bigint")
    df = df.withColumn("noise", importance.gumbel(F.xxhash64("doc_id")))
    got = importance.drawn(df, 100).collect()
    keys = sorted((r["log_weight"] + r["noise"] for r in got), reverse=True)
    assert {r["doc_id"] for r in got if r["kept"]} == {r["doc_id"] for r in got if r["key"] >= keys[99]}
    assert importance.drawn(df, 0).where("kept").count() == 0 and importance.drawn(df, 10**6).where("kept").count() == 400


def test_noise_is_standard_gumbel(spark):
    mean, deviation = spark.range(40_000).select(importance.gumbel(F.xxhash64("id")).alias("g")).agg(F.avg("g"), F.stddev("g")).first()
    assert mean == pytest.approx(0.5772, abs=0.03) and deviation == pytest.approx(math.pi / 6**0.5, abs=0.03)


def test_edge_cases(spark):
    rows = [(1, None), (2, ""), (3, "good text here"), (3, "good text here"), (None, "more Good text"), (4, "z " * 100_000), (5, "***")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumns({"of": F.lit(1), "key": F.lit("clash"), "mark": F.lit(0)})
    none = spark.createDataFrame([], "doc_id bigint, quality int")
    assert importance.selected(docs, none).where("kept").count() == len(rows)
    labels = spark.createDataFrame([(3, 1), (5, 0), (None, 1), (77, None)], "doc_id bigint, quality int")
    out = importance.accepted(docs, labels)
    assert out.columns == docs.columns and out.count() <= len(rows)
    assert importance.accepted(docs.where("false"), labels).count() == 0
    weights = {r["doc_id"]: r["log_weight"] for r in importance.selected(docs, labels).collect()}
    assert weights[1] == weights[2] == 0.0
