"""Registered queries on rows without an id and with repeated ids."""

import hashlib
from collections import Counter

from seriesmill.llm.queries import QUERIES


def test_op3_gives_one_row_for_every_row(spark, tmp_path):
    line = "the quick brown fox jumps over the lazy dog and runs away from it, number {} of many. "
    texts = [line.format(k) * (k + 1) for k in range(8)]
    rows = [(None, texts[0]), (None, None), (1, texts[1]), (2, texts[2]), (2, texts[2]), (2, texts[3]), (0, texts[4]), (9, texts[5]), (None, texts[0])]
    spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = QUERIES["op3_document_fingerprints"](spark, str(tmp_path)).collect()
    assert Counter((r["doc_id"], r["n_chars"]) for r in got) == Counter((i, len(t or "")) for i, t in rows)
    marks = {(r["t"] or ""): r["h"] for r in spark.createDataFrame(rows, "i bigint, t string").selectExpr("t", "xxhash64(coalesce(t, '')) as h").collect()}
    order = sorted(((i is not None, i or 0, marks[t or ""], t or "") for i, t in rows))
    want = Counter()
    for k, (some, i, _, t) in enumerate(order):
        after = order[(k + 1) % len(order)][3]
        edited = t[:len(t) - len(t) // 4] + after[:len(t) // 4]
        want[i if some else None, hashlib.sha256(edited.encode()).hexdigest()] += 1
    assert Counter((r["doc_id"], r["edited_sha256"]) for r in got) == want
