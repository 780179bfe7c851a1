"""Rank-order language profiles against a plain loop."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from seriesmill.llm import langid


def plain_counts(text):
    words, now = [], ""
    for c in text.lower() + " ":
        if c.isalpha():
            now += c
        elif now:
            words.append(now)
            now = ""
    line = " " + " ".join(words) + " " if words else ""
    return Counter(line[i:i + n] for n in (1, 2, 3) for i in range(len(line) - n + 1)
                   if line[i:i + n] != " " and not (n == 3 and line[i + 1] == " "))


def number(gram):
    out = 0
    for c in gram:
        out = out << 21 | (0x110000 if c == " " else ord(c))
    return out


@pytest.mark.parametrize("text", ["", "..", "a", "Ab, ab  c1d", "İß x", "日本 語", "é-É", "x" * 50])
def test_counts(text):
    numbers, counts = langid.counts_of(text)
    assert {int(n): int(c) for n, c in zip(numbers, counts)} == {number(g): c for g, c in plain_counts(text).items()}


def test_very_long_texts_are_counted_in_parts(monkeypatch):
    rng = random.Random(1)
    text = "".join(rng.choices("abc  d.", k=5000))
    want = langid.counts_of(text)
    monkeypatch.setattr(langid, "CHARS", 64)
    got = langid.counts_of(text)
    assert (want[0] == got[0]).all() and (want[1] == got[1]).all()
    assert [int(x) for x in langid.counts_of("q" * 500)[1]] == [int(x) for x in langid.counted(langid.grams(langid._codes("q" * 500)))[1]]


def test_distance_is_out_of_place():
    profiles = {n: langid.ranked(*langid.counts_of(t), 5) for n, t in (("x", "abab abab cab"), ("y", "dede edde ced"))}
    judge = langid.Judge(profiles, 5)
    for text in ("abba cab", "eddc", "zzz", "ab ed"):
        mine = [int(g) for g in langid.ranked(*langid.counts_of(text), 5)]
        want = []
        for name in ("x", "y"):
            ranks = {int(g): k for k, g in enumerate(profiles[name])}
            want.append(sum(abs(ranks[g] - k) if g in ranks else 5 for k, g in enumerate(mine)) / (5 * len(mine)))
        assert judge.distances(text) == pytest.approx(want)
    assert judge.judge("zzz")[0] == "x"  # equal distances: the first by name


def test_queries_and_edges(spark):
    rng = random.Random(3)
    alphabets = {"xx": "abcde", "yy": "defgh", "zz": "жзий"}
    text = lambda k: " ".join("".join(rng.choices(alphabets[k], k=rng.randint(2, 6))) for _ in range(40))
    rows = [(i, text(k), k) for i, k in enumerate(list(alphabets) * 40)]
    extra = [(900, None, "xx"), (901, "", "xx"), (902, "12 !!", None), (903, text("zz") * 500, None), (903, text("yy"), None), (None, text("xx"), None)]
    df = spark.createDataFrame(rows + extra, "doc_id bigint, text string, lang string").withColumns({"score": F.lit(1), "n": F.lit("x")})
    got = langid.identify(df.drop("score"), langid.learn(df), ["doc_id", "lang", "n"]).collect()
    assert len(got) == len(rows) + len(extra)
    assert all(r["lang_pred"] == r["lang"] for r in got if r["doc_id"] is not None and r["doc_id"] < 900)
    assert {r["doc_id"]: r["lang_pred"] for r in got if r["doc_id"] in (900, 901, 902)} == dict.fromkeys((900, 901, 902), "und")
    assert all(0 <= r["score"] <= 1 for r in got)
    assert langid.learn(df.where("false")) == {}
    assert {r["lang_pred"] for r in langid.identify(df, {}, ["doc_id"]).collect()} == {"und"}
    assert langid.identify(df.where("false"), langid.learn(df), ["doc_id"]).count() == 0


def test_profiles_count_all_rows(spark):
    rows = [(f"ab{'c' * (i % 5)} d", "l") for i in range(200)]
    df = spark.createDataFrame(rows, "text string, lang string").repartition(9)
    want = sum((plain_counts(t) for t, _ in rows), Counter())
    numbers = np.array(sorted(number(g) for g in want), dtype=np.uint64)
    back = {number(g): c for g, c in want.items()}
    expected = langid.ranked(numbers, np.array([back[int(n)] for n in numbers]), 8)
    assert (langid.learn(df, most=8)["l"] == expected).all()
