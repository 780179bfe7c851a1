"""The registered queries and the pipeline against brute force on the smallest tables."""

import hashlib
import os
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from test_mixing import targets
from test_nearcopies import plain_groups
from test_simhash import plain_components, plain_print

import corpus_pipeline
from seriesmill.llm import tokens
from seriesmill.llm.common import settle
from seriesmill.llm.queries import CONTROL_TEXT, ORACLES, QUERIES

SF = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def docs():
    return pd.read_parquet(f"{SF}/documents.parquet").sort_values("doc_id").reset_index(drop=True)


def run(spark, name):
    return QUERIES[name](spark, SF).toPandas()


def words(text):
    return len((text or "").encode().split())


def test_every_operator_has_a_query():
    assert sorted(int(q[2:].split("_")[0]) for q in QUERIES if q.startswith("op")) == list(range(1, 14))
    assert set(ORACLES) <= set(QUERIES)


def test_op1(spark, docs):
    got = run(spark, "op1_rank_order_language").merge(docs, on="doc_id")
    assert len(got) == len(docs)
    assert (got.held_out == got.doc_id.map(lambda i: zlib.crc32(str(i).encode()) % 4 == 2)).all()
    seen = got[got.held_out & got.lang.notna() & (got.n_chars > 40)]
    assert (seen.lang == seen.lang_pred).mean() >= 0.97
    assert got.score.between(0, 1).all() and set(got.lang_pred) <= {*docs.lang.dropna(), "und"}


def test_op2(spark):
    given = pd.read_parquet(f"{SF}/conversations.parquet").sort_values(["conv_id", "turn"])
    want = {i: list(zip(g.role, g.text.fillna(""))) for i, g in given.groupby("conv_id")}
    want[-7] = [("user", CONTROL_TEXT), ("assistant", CONTROL_TEXT)]
    got = {r.conv_id: r for r in run(spark, "op2_chat_template").itertuples()}
    assert set(got) == set(want)
    for i, turns in want.items():
        said = "".join(t for r, t in turns if r == "assistant")
        whole = "".join(f"{r}\n{t}\n" for r, t in turns)
        assert got[i].n_turns == len(turns) and got[i].turns_sha256 == hashlib.sha256(whole.encode()).hexdigest()
        assert got[i].loss_chars == len(said) and got[i].loss_sha256 == hashlib.sha256(said.encode()).hexdigest()
        assert got[i].formatted_chars > len(whole)


def test_op3(spark, docs):
    got = run(spark, "op3_document_fingerprints").sort_values("doc_id").reset_index(drop=True)
    texts = docs.text.fillna("").tolist()
    hashes = lambda p: {w.partition(":")[0] for w in p.split()}
    prints = [hashes(p) for p in got.fingerprint]
    like = lambda a, b: len(a & b) / len(a | b) if a | b else 1.0
    for k, (r, t) in enumerate(zip(got.itertuples(), texts)):
        after = (k + 1) % len(texts)
        edited = t[:len(t) - len(t) // 4] + texts[after][:len(t) // 4]
        assert r.n_chars == len(t) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert r.near_edited == pytest.approx(like(prints[k], hashes(r.edited_fingerprint)))
        assert r.near_next == pytest.approx(like(prints[k], prints[after]))
    long = got[(got.n_chars > 200) & ([len(p) > 30 for p in prints])]  # periodic junk has few distinct grams
    assert long.near_edited.min() > 0.2 and long.near_edited.mean() > 0.5 and long.near_next.mean() < 0.05
    by_text = {}
    for t, p, e in zip(texts, got.fingerprint, got.edited_fingerprint):
        assert isinstance(p, str) and by_text.setdefault(t, p) == p
        for print_ in (p, e):  # positions ascend and lie in the text
            at = [int(w.partition(":")[2]) for w in print_.split()]
            assert at == sorted(at) and all(0 <= x < len(t) for x in at)


def test_op4(spark, docs):
    got = run(spark, "op4_feistel_shards").merge(docs, on="doc_id")
    assert len(got) == len(docs) and set(got.law) == {"rows"} and got.grown_shard.isna().all()
    assert (got["size"] == got.text.map(lambda t: len((t or "").encode()) + 16)).all()
    assert (got.text_crc32 == got.text.map(lambda t: zlib.crc32((t or "").encode()))).all()
    sizes = got.groupby("shard").slot.agg(["count", "max", "nunique"])
    assert set(sizes.index) == set(range(40)) and np.ptp(sizes["count"]) <= 1
    assert (sizes["max"] == sizes["count"] - 1).all() and (sizes["nunique"] == sizes["count"]).all()


def test_op5(spark, docs):
    got = run(spark, "op5_simhash_pivots").sort_values("doc_id").reset_index(drop=True)
    prints = np.array([plain_print(t) for t in docs.text], dtype=np.uint64)
    assert got.fingerprint.tolist() == [f"{p:016x}" for p in prints.tolist()]
    label = plain_components(prints)
    assert got.component_id.tolist() == docs.doc_id.groupby(label).transform("min").tolist()


def test_op6(spark, docs):
    got = run(spark, "op6_source_mix").merge(docs, on="doc_id")
    assert len(got) == len(docs) and (got["size"] == got.text.map(words)).all() and (got.taken <= 2 * got["size"]).all()
    by = got.groupby("source").agg(size=("size", "sum"), given=("source_size", "first"), target=("target", "first"), taken=("taken", "sum"))
    by = by.sort_index()
    want = targets(by["size"].tolist(), [(3, 1, 2)[k % 3] for k in range(len(by))], 1.5, 2)
    assert (by["size"] == by.given).all() and np.allclose(by.target, want)
    assert abs(by.taken.sum() - sum(want)) < 0.02 * sum(want)
    assert got.set_index("doc_id").taken.to_dict() == run(spark, "op6_source_mix").set_index("doc_id").taken.to_dict()


def test_op7(spark, docs):
    got = run(spark, "op7_importance_resampling")
    marks = got.merge(pd.read_parquet(f"{SF}/labels.parquet"), on="doc_id")
    assert len(got) == len(docs) and (marks.kept == (marks.quality == 1)).mean() > 0.9


def test_op10(spark, docs):
    got = run(spark, "op10_grouped_packing")
    encode, want = tokens.encoder(tokens.vocabulary()), Counter()
    for i, t in zip(docs.doc_id, docs.text):
        ids = np.array([*encode(t or ""), 2], dtype="<u4")
        for k, (a, n) in enumerate(tokens.cut(len(ids), 1024)):
            want[i, k, a, n, zlib.crc32(ids[a:a + n].tobytes())] += 1
    assert Counter(zip(got.doc_id, got.piece, got.start, got.length, got.ids_crc32)) == want
    for _, g in got.sort_values("offset").groupby("sequence_id"):
        assert (g.offset.to_numpy() == np.concatenate([[0], g.length.cumsum()[:-1]])).all() and g.length.sum() <= 1024
    assert got.sequence_id.nunique() <= 1.02 * got.length.sum() / 1024 + 2


def test_pipeline_stages(spark, docs):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert len(names) == 5 and corpus_pipeline.ORACLE_SQL is None
    now, seen = spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        now = settle(stage(spark, now, SF), "test")
        seen.append(now.toPandas())
    good, exact, near, mix, packed = seen
    for part in seen[:4]:
        assert list(part.columns) == ["doc_id", "text", "lang", "source", "n_chars"]
    marks = docs.merge(pd.read_parquet(f"{SF}/labels.parquet"), on="doc_id")
    assert set(marks[marks.quality == 1].doc_id) - set(good.doc_id) == set() or len(set(marks[marks.quality == 1].doc_id) - set(good.doc_id)) <= 2
    low = lambda t: (t or "").encode().lower()
    want = good.assign(key=good.text.map(low)).groupby("key").doc_id.max()
    assert sorted(exact.doc_id) == sorted(want)
    label = plain_groups(exact.text.tolist())
    assert sorted(near.doc_id) == sorted(exact.doc_id.groupby(label).min())
    assert set(mix.doc_id) <= set(near.doc_id) and mix.groupby("doc_id").size().max() <= 2
    taken, sizes = mix.text.map(words).sum(), near.text.map(words).sum()
    assert abs(taken - 1.5 * sizes) < 0.05 * sizes
    assert Counter(packed[packed.piece == 0].doc_id) == Counter(mix.doc_id)


def test_pipeline_takes_odd_tables(spark, tmp_path):
    """Nulls, repeated rows, an empty table and columns with clashing names pass every stage."""
    rows = spark.read.parquet(f"{SF}/documents.parquet")
    odd = spark.createDataFrame([(None, None, None, None, None), (5, "", "en", None, 0), (5, "", "en", None, 0), (10**9, "Aa bb. " * 40_000, None, "zz", 1)], rows.schema)
    extra = rows.limit(40).unionByName(odd).selectExpr("*", "1 as mark", "'x' as place", "2 as size", "3 as of", "4 as digest")
    for table in (extra, extra.where("false")):
        now = table
        for _, stage in corpus_pipeline.STAGES[:-1]:
            now = settle(stage(spark, now, SF), "odd")
            assert now.columns == extra.columns
        assert (settle(corpus_pipeline.STAGES[-1][1](spark, now, SF), "odd").count() > 0) == (table is extra)
