"""Packing: the plan's runs, Spark's assignment, token ids and cuts."""

import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from seriesmill.llm import packing, tokens


def filled(runs, most):
    """The sequences of a plan, checked for gaps and overflow."""
    out = {}
    for length, _, count, first, offset in runs:
        for k in range(count):
            out.setdefault(first + k, []).append((offset, length))
    for parts in out.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= most
    return out


def best_fit(lengths, most):
    rooms = []
    for n in sorted(lengths, reverse=True):
        fits = [r for r in rooms if r >= n]
        if fits:
            rooms.remove(min(fits))
            rooms.append(min(fits) - n)
        else:
            rooms.append(most - n)
    return len(rooms)


@pytest.mark.parametrize("n,seed", [(0, 0), (1, 0), (7, 1), (200, 2), (3000, 3)])
@pytest.mark.parametrize("low,high", [(1, 1024), (340, 700), (500, 530), (1, 30)])
def test_plan_holds_every_piece(n, seed, low, high):
    rng = random.Random(seed)
    lengths = [rng.choice([1024, rng.randint(low, high)]) for _ in range(n)]
    runs = packing.plan(Counter(lengths), 1024)
    ranks = {}
    for length, rank, count, _, _ in runs:
        ranks.setdefault(length, []).extend(range(rank, rank + count))
    assert {k: sorted(v) for k, v in ranks.items()} == {k: list(range(v)) for k, v in Counter(lengths).items()}
    used = filled(runs, 1024)
    assert sorted(used) == list(range(len(used)))
    assert len(used) <= 1.03 * best_fit(lengths, 1024) + 3


def test_configurations_meet_the_bound():
    """Halves, thirds and the rest in known proportion: the program finds the perfect packing."""
    found = packing.configurations([600, 424, 341], [100, 100, 300], 1024)
    assert sum(a for _, a in found) == pytest.approx(200, abs=1e-6)


def test_cut():
    assert tokens.cut(1, 4) == [(0, 1)] and tokens.cut(4, 4) == [(0, 4)] and tokens.cut(9, 4) == [(0, 1), (1, 4), (5, 4)] and tokens.cut(8, 4) == [(0, 4), (4, 4)]


TEXTS = ["", "Hello world", "  two  spaces\n\n", "é😀 ü", "<|endoftext|> x", "it's 123 don't", "a" * 3000, None, "Laèoueau la ément. " * 900]


def test_ids_are_those_of_tokenizers():
    exact, encode = Tokenizer.from_file(tokens.vocabulary()), tokens.encoder(tokens.vocabulary())
    for t in TEXTS:
        assert list(encode(t or "")) == exact.encode(t or "", add_special_tokens=False).ids


def test_documents_are_packed_whole(spark):
    rng = random.Random(5)
    texts = TEXTS + [" ".join(rng.choices(["the", "of", "Enöver", "###", "42"], k=rng.randint(0, 3000))) for _ in range(60)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(3, TEXTS[3]), (3, TEXTS[3]), (None, "null id")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumns({"rank": F.lit(1), "offset": F.lit("clash")})
    got = packing.pack_documents(df).collect()
    exact, want, total = Tokenizer.from_file(tokens.vocabulary()), Counter(), 0
    for i, t in rows:
        ids = np.array([*exact.encode(t or "", add_special_tokens=False).ids, 2], dtype="<u4")
        total += len(ids)
        for k, (a, n) in enumerate(tokens.cut(len(ids), 1024)):
            want[i, k, a, n, zlib.crc32(ids[a:a + n].tobytes())] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == want
    places = {}
    for r in got:
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in places.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= 1024
    assert len(places) <= 1.05 * total / 1024 + 2
    assert packing.pack_documents(df.where("false")).count() == 0


def test_sequences_hold_the_ids(spark):
    df = spark.createDataFrame([(i, f"text number {i} " * (i % 90)) for i in range(120)], "doc_id bigint, text string")
    with_ids = tokens.pieces(df, with_ids=True)
    placed = packing.packed(with_ids.drop("ids"))
    whole = packing.assembled(placed, with_ids).collect()
    assert sum(len(r["ids"]) for r in whole) == with_ids.agg(F.sum("length")).first()[0] and max(len(r["ids"]) for r in whole) <= 1024
    assert all(r["ids"][-1] == 2 for r in whole)


def test_other_lengths_fail(spark):
    for n in (0, 1025, None):
        with pytest.raises(ValueError):
            packing.packed(spark.createDataFrame([(1, 0, n)], "doc_id bigint, piece int, length bigint"))
