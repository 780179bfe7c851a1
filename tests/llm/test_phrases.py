"""Collocations against plain counts."""

import random
import re
from collections import Counter

import pandas as pd

from seriesmill.llm import phrases
from seriesmill.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def plain(rows, support=10, longest=3, top=2000):
    """lang, rank, phrase, a, l, r, n, score by counting every phrase."""
    count, out = {}, []
    for lang, text in rows:
        low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        f = count.setdefault("und" if lang is None else lang, Counter())
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            words = re.findall(r"[^\x20\x09]+", piece)
            for size in range(1, longest + 1):
                f.update(zip(*[words[k:] for k in range(size)]))
    for lang, f in count.items():
        n = sum(v for p, v in f.items() if len(p) == 1)
        found = {p: v for p, v in f.items() if len(p) > 1 and v >= support}
        ranked = []
        for p, a in found.items():
            score, k = min((10**6 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            inside = lambda q: any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1))
            if not any(len(q) > len(p) and inside(q) and 100 * v >= 50 * a for q, v in found.items()):
                ranked.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(ranked)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n, -score))
    return sorted(out)


def rows(df):
    return sorted(tuple(r[c] for c in ("lang", "rank", "phrase", "a", "l", "r", "n", "score")) for r in df.collect())


def made(seed=1):
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(12)] + ["New", "york", "É", "a-b", "x\xa0y"]
    ends = [" ", " ", " ", "\t", ", ", ". ", "\n", "\x0b", " ; "]
    given = []
    for k in range(80):
        text = "".join(rng.choice(words) + rng.choice(ends) for _ in range(rng.randrange(0, 120)))
        given.append((rng.choice(["en", "en", "en", "fr", None, "und"]), text + (" New York city hall." if k % 3 else " new york city")))
    return [*given, ("de", None), (None, ""), ("de", "..!"), ("en", "new york " * 2000)]


def test_made_texts_equal_plain_counts_for_any_shards(spark):
    given = made()
    df = spark.createDataFrame(given, "lang string, text string").selectExpr("*", "1 as phrase", "2 as shard", "'x' as group", "3 as n").repartition(3)
    for shards, support in ((4, 10), (1, 10), (7, 3)):
        assert rows(phrases.collocations(df, shards=shards, support=support)) == plain(given, support)
    assert rows(phrases.collocations(df, top=3, longest=4)) == plain(given, longest=4, top=3)


def test_small_buffers_change_nothing(spark, monkeypatch):
    given = made(2)
    raw = [t for _, t in given]
    whole = list(phrases._gathered([pa_batch(raw)], 10**9))
    parts = list(phrases._gathered([pa_batch(raw)], 50))
    assert len(whole) == 1 and len(parts) > 10
    count = lambda many: sum((Counter([t.words[c] for c in t.codes]) for t in many), Counter())
    assert count(whole) == count(parts)


def test_words_are_cut_in_one_go_as_text_by_text():
    texts = ["", " ", "\t\t a. b", "\x0bx\x0c", "é ü. Ab\r\nc\x1fd", " lead", "trail ", ".", "...", "NEW york", "\xa0 \x00"]
    raw = [t.encode() for t in texts]
    tokens, lengths = phrases._split(raw)
    want = [re.findall(rb"\xff|[^\xff ]+", re.sub(rb"[.,;:!?\n-\r]", b"\xff", t.replace(b"\t", b" ")) + b"\xff") for t in raw]
    lower = lambda w: re.sub(rb"[A-Z]", lambda m: m.group().lower(), w)
    assert lengths.tolist() == [len(w) for w in want]
    assert tokens.to_pylist() == [lower(w) for ws in want for w in ws]


def test_phrases_are_numbered_where_words_do_not_fit_one_number(monkeypatch):
    """Five words of 20 000 distinct ones pass 63 bits: counts stay exact."""
    texts = [" ".join(f"w{k}" for k in range(20_000)), "a b c d e f " * 3]
    bits = type("Bits", (), {"value": b"\xff" * (1 << phrases.BITS - 3)})
    found = Counter()
    for batch in phrases._counted(5, [bits] * 4, {7: 1})(iter([pa_batch(texts)])):
        for group, phrase, words, n in zip(*[c.to_pylist() for c in batch.columns]):
            found[phrase] += n
    plainly = Counter()
    for text in texts:
        words = text.split()
        for size in range(2, 6):
            plainly.update(" ".join(w) for w in zip(*[words[k:] for k in range(size)]))
    assert found == plainly


def pa_batch(texts):
    import pyarrow as pa
    return pa.RecordBatch.from_arrays([pa.array(texts, pa.string()), pa.array([7] * len(texts), pa.int64())], ["text", "group"])


def test_op12_equals_plain_counts(spark):
    docs = pd.read_parquet(f"{SF}/documents.parquet")
    assert rows(QUERIES["op12_son_collocations"](spark, SF)) == plain(zip(docs.lang, docs.text))


def test_op12_takes_an_empty_table(spark, tmp_path):
    spark.createDataFrame([], "doc_id bigint, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    assert QUERIES["op12_son_collocations"](spark, str(tmp_path)).count() == 0
