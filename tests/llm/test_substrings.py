"""Repeated substrings against a table of all windows."""

import hashlib
import random
from collections import Counter

import numpy as np
import pandas as pd

from seriesmill.llm import substrings
from seriesmill.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def plain(texts, length=400):
    """Per text: bytes, removed bytes, spans and the digest of what is left."""
    raws = [(t or "").encode() for t in texts]
    seen = Counter(r[i:i + length] for r in raws for i in range(len(r) - length + 1))
    out = []
    for r in raws:
        gone = np.zeros(len(r) + 1, dtype=bool)
        for i in range(len(r) - length + 1):
            if seen[r[i:i + length]] > 1:
                gone[i:i + length] = True
        out.append((len(r), int(gone.sum()), int((gone[1:] < gone[:-1]).sum()),
                    hashlib.sha256(bytes(b for b, g in zip(r, gone) if not g)).hexdigest()))
    return out


def rows(df):
    return sorted((-1 if r["doc_id"] is None else r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in df.collect())


def test_suffix_array_equals_a_sort():
    rng = np.random.default_rng(0)
    for _ in range(300):
        text = np.append(rng.integers(1, 1 + rng.integers(1, 4), rng.integers(1, 60)), 0).astype(np.uint8)
        raw = text.tobytes()
        assert substrings.suffix_array(text, 100).tolist() == sorted(range(len(raw)), key=lambda i: raw[i:])


def test_repeated_starts_equal_a_count():
    rng = random.Random(1)
    for _ in range(50):
        pieces = ["".join(rng.choices("ab", k=rng.randrange(8, 40))).encode() for _ in range(rng.randrange(1, 6))]
        seen = Counter(p[i:i + 8] for p in pieces for i in range(len(p) - 7))
        got = substrings.repeated_starts(pieces, 8)
        assert [g.tolist() for g in got] == [[i for i in range(len(p) - 7) if seen[p[i:i + 8]] > 1] for p in pieces]


def test_every_window_has_one_anchor_and_equal_windows_choose_alike():
    rng = random.Random(2)
    base = "".join(rng.choices("abcd", k=3000))
    texts = [base, "x" + base[500:2500] + "y", "z" * 900]
    at = {}
    for t in texts:
        raw = t.encode()
        windows = [w for _, a, b in substrings.anchors(raw).tolist() for w in range(a, b + 1)]
        assert windows == list(range(len(raw) - 399))
        for anchor, a, b in substrings.anchors(raw).tolist():
            for w in range(a, b + 1):
                assert at.setdefault(raw[w:w + 400], anchor - w) == anchor - w


def made(seed=5):
    """Passages that many texts share at other places, copies with edits, repeats inside a text, periodic texts."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdefghij é", k=rng.randrange(2, 9)))
    prose = lambda n: " ".join(word() for _ in range(n))
    passage, exact = prose(100), "q" * 5 + prose(90)[:394]
    texts = [prose(rng.randrange(10, 200)) for _ in range(20)]
    texts += [prose(rng.randrange(1, 40)) + passage[rng.randrange(60):len(passage) - rng.randrange(60)] + prose(rng.randrange(1, 40)) for _ in range(60)]
    base = prose(300)
    for _ in range(30):
        cut = rng.randrange(200, len(base) - 200)
        texts.append(base[:cut] + word() + base[cut + 3:])
    texts += [texts[0], texts[0], base, base, "ab" * 500, "a" * 399, "a" * 400, "a" * 401, "a" * 2000, passage + " " + passage, exact, "x" + exact, exact[:399]]
    texts += [None, "", "é" * 199 + "x", "é" * 200, "é" * 200 + "y", "\x00" * 450]
    return texts


def test_made_texts_equal_a_count_for_any_crowd(spark, tmp_path):
    texts = made()
    want = sorted((i, *w) for i, w in enumerate(plain(texts)))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").selectExpr("*", "1 as mark", "2 as spans", "3 as copies").repartition(5)
    for crowd in (substrings.CROWD, 3):  # few stretches a key: the hot passage is refined down to single windows
        left = substrings.without_repeats(df, crowd=crowd)
        got = sorted((r["doc_id"], r["n_bytes"], sum(x["end"] - x["begin"] for x in r["removed"]), len(r["removed"]),
                      hashlib.sha256(r["kept"]).hexdigest()) for r in left.collect())
        assert got == want


def test_op13_equals_a_count(spark):
    docs = pd.read_parquet(f"{SF}/documents.parquet")
    want = sorted((i, *w) for i, w in zip(docs.doc_id.tolist(), plain(docs.text.tolist())))
    assert rows(QUERIES["op13_suffix_repeats"](spark, SF)) == want


def test_op13_takes_odd_rows(spark, tmp_path):
    long = " ".join(f"w{k}" for k in range(40_000))
    given = [(None, "a" * 500), (None, None), (1, "b" * 450), (1, "b" * 450), (1, "c d " * 150), (2, ""), (3, long), (4, long[1000:1500]), (None, "a" * 500)]
    spark.createDataFrame(given, "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = rows(QUERIES["op13_suffix_repeats"](spark, str(tmp_path)))
    short = [(i, t) for i, t in given if t is not long]
    want = sorted((-1 if i is None else i, *w) for (i, _), w in zip(short, plain([t for _, t in short])))
    assert [r for r in got if r[0] not in (3, 4)] == [r for r in want if r[0] != 4]
    by = {r[0]: r for r in got}
    assert by[4][2] == 500 and by[3][1:4] == (len(long), 500, 1)
    assert by[3][4] == hashlib.sha256((long[:1000] + long[1500:]).encode()).hexdigest()
    spark.createDataFrame([], "doc_id bigint, text string").write.parquet(f"{tmp_path}/none/documents.parquet")
    assert QUERIES["op13_suffix_repeats"](spark, f"{tmp_path}/none").count() == 0
