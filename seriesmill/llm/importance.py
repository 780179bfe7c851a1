"""Quality selection by importance resampling.

Two generative models over hashed n-grams are fitted: one on the target texts, one on all
texts.  A document's importance is the ratio of its likelihoods; documents are drawn without
replacement by Gumbel top-k: the k largest of log importance plus Gumbel noise.

The n-grams are those of the words (one and two) and of the surface forms (one to three):
a word counts as lower case, capitalised, upper case, number, mixed or a repeat of the word
before it; a run of other signs counts as itself.

Defined results
    a null or empty text has no n-grams and log importance 0; sums run over the whole text; the
    noise is a hash of id and text, so reruns draw the same documents; rows with the same id
    and text stand or fall together, so ties at the k-th place all stay; further columns are
    kept or passed over; without target texts every ratio is 1; without bad labels k is
    the number of rows; an empty table gives none.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from seriesmill.llm.common import bounded, numbered, settle, unused

#: Words fall into few buckets, so that a bucket's ratio rests on many words and a document's
#: own rare words do not decide about it; surface forms are few and need none of that.
WORD_BITS, FORM_BITS = 8, 14
BUCKETS = (1 << WORD_BITS) + (1 << FORM_BITS)
#: Of the labelled rows, those of one hash class in three set the number to draw, the others fit the target model.
FOLDS = 3
#: The target model is fitted on at most about this many labelled rows; all else covers all rows.
FIT_ROWS = 200_000
#: Characters that are turned to n-grams in one go.
CHARS = 1 << 20
SPACE, LOWER, UPPER, DIGIT, OTHER_LETTER, SIGN = range(6)
_K = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], dtype=np.uint64)


@lru_cache(maxsize=1)
def _alphabet() -> tuple[np.ndarray, np.ndarray]:
    """Class and lower-case form of the first 65 536 code points; later ones are letters without case."""
    kind, lower = np.full(65_537, OTHER_LETTER, dtype=np.uint8), np.arange(65_537, dtype=np.uint32)
    for code in range(65_536):
        c = chr(code)
        kind[code] = (SPACE if c.isspace() else LOWER if c.islower() else UPPER if c.isupper() else
                      DIGIT if c.isdigit() else OTHER_LETTER if c.isalpha() else SIGN)
        if kind[code] == UPPER and len(c.lower()) == 1:
            lower[code] = ord(c.lower())
    return kind, lower


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _K[0]
    return (x ^ (x >> np.uint64(29))) * _K[1]


def ngrams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(text number, bucket) of every n-gram of the texts."""
    lines = [(t or "").encode("utf-32-le", "replace") for t in texts]
    sizes = np.array([len(b) // 4 + 1 for b in lines])
    codes = np.frombuffer(b"".join(b + b" \0\0\0" for b in lines), dtype="<u4")
    kind_of, lower_of = _alphabet()
    known = np.minimum(codes, 65_536)
    kind, low = kind_of[known], np.where(codes < 65_536, lower_of[known], codes).astype(np.uint64)
    group = np.where(kind == SPACE, 0, np.where(kind == SIGN, 2, 1)).astype(np.int8)
    begins = np.empty(len(group), dtype=bool)
    if not len(group):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    begins[0], begins[1:] = group[0] > 0, (group[1:] != group[:-1]) & (group[1:] > 0)
    start = np.nonzero(begins)[0]
    if not len(start):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    inside = group > 0
    # spaces add nothing to the sum of the token before them
    place = np.arange(len(codes)) - np.repeat(start, np.diff(np.append(start, len(codes)))) if start[0] == 0 else None
    if place is None:
        place = np.arange(len(codes))
        place[start[0]:] -= np.repeat(start, np.diff(np.append(start, len(codes))))
    weight = _mixed(np.arange(1, 257, dtype=np.uint64))[place & 255]
    word = _mixed(np.add.reduceat(np.where(inside, (low + np.uint64(7)) * weight, np.uint64(0)), start))
    count = lambda k: np.add.reduceat((kind == k).astype(np.int32), start)
    lowers, uppers, digits, others = count(LOWER), count(UPPER), count(DIGIT), count(OTHER_LETTER)
    letters = lowers + uppers + digits + others
    form = np.full(len(start), 5, dtype=np.uint64)
    form[lowers == letters] = 0
    form[(uppers == 1) & (kind[start] == UPPER) & (lowers + 1 == letters)] = 1
    form[(uppers == letters) & (uppers > 1)] = 2
    form[digits == letters] = 3
    form[others == letters] = 4
    text = np.repeat(np.arange(len(texts)), np.diff(np.searchsorted(start, np.concatenate([[0], np.cumsum(sizes)]))))
    is_word = letters > 0
    where = np.nonzero(is_word)[0]
    again = where[1:][(word[where[1:]] == word[where[:-1]]) & (text[where[1:]] == text[where[:-1]])]
    form[again] = 6
    form = np.where(is_word, form + np.uint64(1), word)
    owner, bucket = [], []
    for stream, orders, bits, base in ((word, 2, WORD_BITS, 0), (form, 3, FORM_BITS, 1 << WORD_BITS)):
        gram = np.zeros(len(start), dtype=np.uint64)
        for order in range(1, orders + 1):
            n = len(start) - order + 1
            if n <= 0:
                break
            gram = _mixed(gram[:n] * _K[2] + stream[order - 1:] + np.uint64(1))
            whole = text[:n] == text[order - 1:]
            owner.append(text[:n][whole])
            bucket.append(base + (_mixed(gram[whole] + np.uint64(order)) >> np.uint64(64 - bits)).astype(np.int64))
    return np.concatenate(owner), np.concatenate(bucket)


def _portions(values: list) -> Iterator[tuple[int, int]]:
    """Stretches of texts of about CHARS characters; a longer text stands alone."""
    begin, total = 0, 0
    for i, v in enumerate(values):
        size = len(v or "")
        if total and total + size > CHARS:
            yield begin, i
            begin, total = i, 0
        total += size
    if begin < len(values):
        yield begin, len(values)


def fit(docs: DataFrame, text: str, target: str, smooth: float = 1.0) -> np.ndarray:
    """Log ratio of target to raw probability per bucket, counted over all rows.

    Every task sums its rows to one count per bucket; the driver gets a row per bucket.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((2, BUCKETS), dtype=np.int64)
        for batch in batches:
            texts, chosen = batch.column(0).to_pylist(), np.array([bool(x) for x in batch.column(1).to_pylist()])
            for a, b in _portions(texts):
                owner, bucket = ngrams(texts[a:b])
                sums[1] += np.bincount(bucket, minlength=BUCKETS)
                if chosen[a:b].any():
                    sums[0] += np.bincount(bucket[chosen[a:b][owner]], minlength=BUCKETS)
        seen = np.nonzero(sums[1])[0]
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int64()), *[pa.array(s[seen]) for s in sums]], ["bucket", "target", "raw"])

    counted = docs.select(F.col(text).cast("string").alias("text"), F.coalesce(F.col(target), F.lit(False)).alias("target")).mapInArrow(
        run, "bucket bigint, target bigint, raw bigint").groupBy("bucket").agg(F.sum("target"), F.sum("raw")).collect()
    counts = np.zeros((2, BUCKETS))
    for bucket, chosen, raw in counted:
        counts[:, bucket] = chosen, raw
    if not counts[0].sum():
        return np.zeros(BUCKETS)
    share = (counts + smooth) / (counts + smooth).sum(axis=1, keepdims=True)
    return np.log(share[0] / share[1])


def scored(docs: DataFrame, ratios: np.ndarray, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, log_weight, noise, mark`` per row; the ratios travel as one broadcast of a double per bucket."""
    shared = docs.sparkSession.sparkContext.broadcast(ratios)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for batch in batches:
            texts, weights = batch.column(1).to_pylist(), []
            for a, b in _portions(texts):
                owner, bucket = ngrams(texts[a:b])
                weights.append(np.bincount(owner, weights=table[bucket], minlength=b - a))
            values = np.concatenate(weights).astype(float) if weights else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values, pa.float64()), batch.column(2)], ["doc_id", "log_weight", "mark"])

    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"),
                       F.xxhash64(F.col(text)).alias("mark")).mapInArrow(
        run, "doc_id bigint, log_weight double, mark bigint")
    return rows.withColumn("noise", gumbel(F.xxhash64("doc_id", "mark", F.lit(7))))


def _held_out(doc_id: Column) -> Column:
    return F.pmod(F.xxhash64(doc_id, F.lit(3)), F.lit(FOLDS)) == 0


def sampled_labels(labels: DataFrame, most: int = FIT_ROWS) -> DataFrame:
    """Ids labelled good, without those held out: all, or about ``most`` chosen by a hash of the id."""
    good = labels.where((F.col("quality") == 1) & ~_held_out(F.col("doc_id"))).select(F.col("doc_id").alias("good_id")).distinct()
    share = min(1.0, most / max(good.count(), 1))
    return good if share == 1.0 else good.where(
        F.shiftrightunsigned(F.xxhash64("good_id"), 11).cast("double") / F.lit(float(1 << 53)) < share)


def acceptable(rows: DataFrame, labels: DataFrame) -> int:
    """How many rows to draw: those above the log importance that best splits held-out good from bad labels.

    Labelled rows are counted by bins of the log importance (a few thousand at most reach the driver).
    """
    bins = F.round(F.asinh("log_weight") * 100).cast("int")
    marks = labels.where(F.col("quality").isNotNull() & _held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("quality").alias("q")).withColumnRenamed("doc_id", "of")
    table = sorted(rows.join(marks, F.col("doc_id") == F.col("of")).groupBy(bins.alias("bin")).agg(
        F.sum(F.when(F.col("q") == 1, 1).otherwise(0)), F.sum(F.when(F.col("q") == 1, 0).otherwise(1))).collect())
    if not sum(r[2] for r in table):
        return rows.count()
    at, good, bad = (np.array(c) for c in zip(*table))
    # cutting below bin i drops the good rows of lower bins and keeps the bad ones from i on
    wrong = np.append(0, np.cumsum(good)) + np.append(np.cumsum(bad[::-1])[::-1], 0)
    edges = np.concatenate([[at[0] - 1], (at[:-1] + at[1:]) / 2, [at[-1] + 1]])
    least = np.nonzero(wrong == wrong.min())[0]
    widths = [at[i] - at[i - 1] if 0 < i < len(at) else 0 for i in least]
    return rows.where(F.asinh("log_weight") * 100 > float(edges[least[int(np.argmax(widths))]])).count()


def drawn(rows: DataFrame, k: int) -> DataFrame:
    """``scored`` rows with ``key`` and ``kept``: the k largest of log importance plus noise."""
    keyed = settle(rows.withColumn("key", F.col("log_weight") + F.col("noise")), "importance")
    ranked, n = numbered(keyed.select("key"), [F.col("key").desc()], "place")
    last = ranked.where(F.col("place") == min(k, n) - 1).first() if k > 0 and n else None
    return keyed.withColumn("kept", F.lit(False) if last is None else F.col("key") >= F.lit(last["key"]))


def selected(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, mark, log_weight, noise, key, kept`` for every row of ``docs``."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    good = bounded(settle(sampled_labels(labels), "good"), 40)
    ratios = fit(rows.join(good, F.col("doc_id") == F.col("good_id"), "left").withColumn(
        "target", F.col("good_id").isNotNull()), "text", "target")
    scores = settle(scored(rows, ratios), "scores")
    return drawn(scores, acceptable(scores, labels))


def accepted(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The drawn rows of ``docs`` with all their columns."""
    of, mark, own = unused(docs.columns, "of", "of_mark", "own_mark")
    out = selected(docs, labels, doc_id, text).where("not kept").select(F.col("doc_id").alias(of), F.col("mark").alias(mark)).distinct()
    rows = docs.withColumn(own, F.xxhash64(F.col(text)))
    return rows.join(out, rows[doc_id].eqNullSafe(out[of]) & (rows[own] == out[mark]), "left_anti").select(*docs.columns)


def gumbel(code: Column) -> Column:
    """Standard Gumbel noise from a 64-bit hash."""
    uniform = (F.shiftrightunsigned(code, 11).cast("double") + F.lit(0.5)) / F.lit(float(1 << 53))
    return -F.log(-F.log(uniform))
