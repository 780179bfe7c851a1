"""Runs against a scan of every period."""

import hashlib
import zlib

import numpy as np
import pandas as pd
import pytest

from seriesmill.llm import periods
from seriesmill.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def plain_runs(words):
    """Every maximal stretch of every period, the smallest period of each stretch."""
    n, found = len(words), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i < n - q:
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            if j > i and j - i + q >= max(6, 4 * q):
                found.setdefault((i, j - i + q), q)
            i = max(j, i + 1)
    return sorted(((a, n, q) for (a, n), q in found.items()), key=lambda r: (r[0], r[2]))


@pytest.mark.parametrize("seed", range(4))
def test_runs_equal_a_scan(seed):
    rng = np.random.default_rng(seed)
    for _ in range(150):
        parts = []
        for k in range(rng.integers(1, 4)):
            n = rng.integers(0, 90)
            part = rng.integers(0, rng.integers(1, 4), n)
            if n and rng.random() < 0.7:
                part = part[periods.with_tail(n, int(rng.integers(0, 1000)))]
            parts += [part, [100 + k]]
        codes = np.concatenate(parts).astype(np.int64)
        assert [tuple(r) for r in periods.runs(codes).tolist()] == plain_runs(codes.tolist())


def test_wavelet_tree_counts_and_ranks():
    rng = np.random.default_rng(7)
    for n in (1, 2, 5, 64, 100):
        values = rng.permutation(n)
        tree = periods.WaveletTree(values)
        low = rng.integers(0, n, 200)
        high = low + rng.integers(0, n - low + 1)
        bound = rng.integers(0, 2 * n + 2, 200)
        assert tree.below(low, high, bound).tolist() == [int((values[a:b] < v).sum()) for a, b, v in zip(low, high, bound)]
        some = high > low
        k = rng.integers(0, (high - low)[some])
        assert tree.smallest(low[some], high[some], k).tolist() == [int(np.sort(values[a:b])[i]) for a, b, i in zip(low[some], high[some], k)]


def test_suffix_ranks():
    codes = np.array([1, 2, 1, 2, 1, 3, 9])
    order, ranks, sizes = periods.suffix_ranks(codes)
    assert order.tolist() == sorted(range(7), key=lambda i: codes[i:].tolist())
    assert sizes[0][ranks[0][0]] == 3 and sizes[1][ranks[1][0]] == 2


def test_long_texts_stay_quick():
    for codes in (np.zeros(200_000, dtype=np.int64), np.arange(200_000) % 31_000):
        codes = np.append(codes, 10**9)
        assert periods.runs(codes).tolist() == [[0, 200_000, 1 if codes[1] == 0 else 31_000]]


def plain_row(i, text):
    words = (text or "").encode().split()
    n, h = len(words), zlib.crc32(str(i).encode()) if i is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if k < a else words[a + (k - a) % p] for k, w in enumerate(words)]
    found = plain_runs(words)
    gone = {k for a, n, p in found for k in range(a + p, a + n)}
    best = None
    for r in found:
        if best is None or r[1] * best[2] > best[1] * r[2]:
            best = r
    return (len(found), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
            hashlib.sha256("".join(f"{a},{n},{p}\n" for a, n, p in found).encode()).hexdigest(),
            hashlib.sha256(b" ".join(w for k, w in enumerate(words) if k not in gone)).hexdigest())


def as_rows(df):
    return sorted(((r["doc_id"] if r["doc_id"] is not None else -1, r["n_runs"], r["start"], r["length"], r["period"], r["exponent_milli"],
                    r["runs_sha256"], r["collapsed_sha256"]) for r in df.collect()), key=str)


def test_op11_equals_a_scan(spark):
    docs = pd.read_parquet(f"{SF}/documents.parquet")
    docs = docs[docs.text.fillna("").str.len() < 12_000]
    got = {r[0]: r[1:] for r in as_rows(QUERIES["op11_periodic_runs"](spark, SF))}
    assert len(got) == len(pd.read_parquet(f"{SF}/documents.parquet"))
    for i, t in zip(docs.doc_id.tolist(), docs.text):
        assert got[i] == plain_row(i, t)


def test_op11_takes_odd_rows(spark, tmp_path):
    texts = [None, "", " \n\t", "a", "a a a a a", "a a a a a a", "x " * 30_000, "a b a b a b a b c", "ß é ß é ß é ß é", "a b a b a b a b c"]
    rows = [(i, t) for i, t in zip([None, 0, 1, 2, 2, 3, 4, 17, 30, 17], texts)]
    spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "1 as tail", "2 as runs").write.parquet(f"{tmp_path}/documents.parquet")
    want = []
    for i, t in rows:
        row = plain_row(i, t) if len(t or "") < 1000 else None
        want.append((-1 if i is None else i, *(row or ())))
    got = as_rows(QUERIES["op11_periodic_runs"](spark, str(tmp_path)))
    assert len(got) == len(rows)
    for w in want:
        if len(w) > 1:
            assert w in got
    long = [r for r in got if r[0] == 4][0]
    assert long[1:5] == (1, 0, 30_000, 1) and long[7] == hashlib.sha256(b"x").hexdigest()
    spark.createDataFrame([], "doc_id bigint, text string").write.parquet(f"{tmp_path}/none/documents.parquet")
    assert QUERIES["op11_periodic_runs"](spark, f"{tmp_path}/none").count() == 0
