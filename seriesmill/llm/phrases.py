"""Phrase collocations by SON partitioning: frequent phrases of each shard first, then exact counts of their union.

The documents are dealt to ``shards``.  A phrase with ``support`` occurrences in a language has, in one shard at
least, its share of them: ``ceil(support * n_shard / n)`` with the words ``n`` of the language.  So each shard is
mined completely at this lowered support, length by length: a phrase counts only if both phrases one word shorter
are frequent in the shard.  What is frequent in some shard is a candidate, and one more pass counts every
candidate over all documents.  A shard is a share of the rows, not a task: its counts are grouped by Spark.

Mining works on 64-bit hashes, and each length hands its frequent phrases on as a bitmap of ``1 << BITS`` bits, a
constant size.  A collision only adds a candidate; the last pass counts the phrases themselves.

Defined results
    letters A-Z are lower-cased; texts are cut at ``. , ; : ! ?`` and the characters line feed to carriage return,
    pieces at spaces and tabs; phrases do not cross pieces; null text has no words; null language is ``und``;
    rows without id and repeated rows count as rows; further columns are passed over; an empty table gives an
    empty result.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from seriesmill.llm.common import measured, settle

SUPPORT, LONGEST, SHARDS, SEED = 10, 3, 4, 42
#: Bits of a bitmap of frequent phrases, as a power of two; bytes of text that are counted in one go.
BITS, BYTES = 25, 5_000_000
#: A cut phrase's score is in millionths.
SCALE = 1_000_000
_END = b"\xff"  # parts pieces; UTF-8 has no such byte
_TABLE = bytes(0xFF if chr(b) in ".,;:!?" or 0x0A <= b <= 0x0D else b + 32 if 65 <= b <= 90 else b for b in range(256))
_ODD = np.uint64(0x9E3779B97F4A7C15)


# --- counting inside a task ------------------------------------------------------------

class Tokens:
    """The words of a stretch of rows as numbers, with the group each word belongs to."""

    def __init__(self, tokens: pa.Array, lengths: np.ndarray, groups: list[int]):
        coded = tokens.dictionary_encode()
        self.dictionary = coded.dictionary
        self.words: list[bytes] = coded.dictionary.to_pylist()
        self.codes = coded.indices.to_numpy().astype(np.int64)
        hashes = np.array([xxhash.xxh64_intdigest(w, SEED) for w in self.words], dtype=np.uint64)
        self.hashes = hashes[self.codes]
        self.inside = self.codes != (self.words.index(_END) if _END in self.words else -1)
        #: Which of the distinct groups a word is in.
        self.names, which = np.unique(np.array(groups, dtype=np.int64), return_inverse=True)
        self.group = np.repeat(which, lengths)

    def phrases(self, size: int) -> np.ndarray:
        """Hashes of the phrases of ``size`` words that start at each word."""
        out = self.hashes
        for k in range(1, size):
            out = (out[:-1] ^ (out[:-1] >> np.uint64(31))) * _ODD + self.hashes[k:]
        return out

    def whole(self, size: int) -> np.ndarray:
        """Where a phrase of ``size`` words starts that stays in its piece."""
        out = self.inside[:len(self.inside) - size + 1].copy() if len(self.inside) >= size else np.zeros(0, dtype=bool)
        for k in range(1, size):
            out &= self.inside[k:len(self.inside) - size + 1 + k]
        return out

    def places(self, hashes: np.ndarray, salts: np.ndarray) -> np.ndarray:
        """Bit numbers of phrases: their hash and their group's salt."""
        return ((hashes ^ salts[self.group[:len(hashes)]]) >> np.uint64(64 - BITS)).astype(np.int64)


def _gathered(batches: Iterator[pa.RecordBatch], limit: int = BYTES) -> Iterator[Tokens]:
    """Rows of ``text, group`` as tokens, a limited number of bytes at a time; every text ends with an end of a piece."""
    texts: list[bytes] = []
    groups: list[int] = []
    size = 0
    for batch in batches:
        for text, group in zip(batch.column(0).cast(pa.binary()).to_pylist(), batch.column(1).to_pylist()):
            texts.append(text or b"")
            groups.append(group)
            size += len(texts[-1]) + 1
            if size >= limit:
                yield Tokens(*_split(texts), groups)
                texts, groups, size = [], [], 0
    if texts:
        yield Tokens(*_split(texts), groups)


def _split(texts: list[bytes]) -> tuple[pa.Array, np.ndarray]:
    """The words and ends of pieces of all texts, and how many of them each text has."""
    raw = np.frombuffer((_END.join(texts) + _END).translate(_TABLE), dtype=np.uint8)
    end, filled = raw == _END[0], (raw != 0x20) & (raw != 0x09)
    # a token starts after a gap, at an end and after one
    fresh = filled & end
    fresh[0] |= filled[0]
    fresh[1:] |= filled[1:] & (~filled[:-1] | end[:-1])
    starts = np.flatnonzero(fresh[filled])
    data = raw[filled]
    offsets = np.append(starts, len(data)).astype(np.int64)
    tokens = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
    # how many tokens start up to the end of each text
    ends = np.cumsum(np.array([len(t) + 1 for t in texts], dtype=np.int64)) - 1
    upto = np.searchsorted(np.flatnonzero(fresh), ends, side="right")
    return tokens, np.diff(upto, prepend=0)


def _has(bits: np.ndarray, places: np.ndarray) -> np.ndarray:
    return bits[places >> 3] >> (places & 7).astype(np.uint8) & 1 == 1


def _batch(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict(columns)


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for t in _gathered(batches):
        key = (t.group * len(t.words) + t.codes)[t.inside]
        if len(t.names) * len(t.words) <= 8 * len(t.codes):  # a place for every word of every group
            every = np.bincount(key)
            key = np.flatnonzero(every)
            n = every[key]
        else:
            key, n = np.unique(key, return_counts=True)
        yield _batch(group=pa.array(t.names[key // len(t.words)]), phrase=t.dictionary.take(pa.array(key % len(t.words))).cast(pa.large_string()).cast(pa.string()),
                     n=pa.array(n.astype(np.int64)))


def _local(size: int, known, salts: dict[int, int]):
    """Counts ``group, hash, n`` of the phrases of ``size`` words whose two shorter phrases are in the bitmap."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(known.value, dtype=np.uint8)
        for t in _gathered(batches):
            part = _has(bits, t.places(t.phrases(size - 1), _salts(t, salts)))
            at = np.flatnonzero(t.whole(size) & part[:-1] & part[1:])
            hashes, group = t.phrases(size)[at], t.group[at]
            order = np.lexsort((hashes, group))
            hashes, group = hashes[order], group[order]
            first = np.flatnonzero(np.concatenate([[True], (hashes[1:] != hashes[:-1]) | (group[1:] != group[:-1])])) if len(at) else np.zeros(0, dtype=np.int64)
            n = np.diff(np.concatenate([first, [len(at)]]))
            yield _batch(group=pa.array(t.names[group[first]]), hash=pa.array(hashes[first].view(np.int64)), n=pa.array(n.astype(np.int64)))
    return run


def _salts(t: Tokens, salts: dict[int, int]) -> np.ndarray:
    return np.array([salts[g] & (1 << 64) - 1 for g in t.names.tolist()], dtype=np.uint64)


def _counted(longest: int, known: Sequence, salts: dict[int, int]):
    """Counts ``group, phrase, words, n`` of the candidates of two words or more."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _gathered(batches):
            # words side by side in one number while they fit, else phrases are numbered length by length: equal numbers are equal phrases
            number, words = t.group * len(t.words) + t.codes, len(t.words)
            most = len(t.names) * words
            for size in range(2, longest + 1):
                if len(number) < 2:
                    break
                if most * words >= 1 << 63:
                    number = np.unique(number, return_inverse=True)[1]
                    most = len(number)
                number, most = number[:-1] * words + t.codes[size - 1:], most * words
                at = np.flatnonzero(t.whole(size) & _has(np.frombuffer(known[size - 2].value, dtype=np.uint8), t.places(t.phrases(size), _salts(t, salts))))
                _, first, n = np.unique(number[at], return_index=True, return_counts=True)
                where = at[first]
                text = pc.binary_join_element_wise(*[t.dictionary.take(pa.array(t.codes[where + k])) for k in range(size)], pa.scalar(b" ", pa.large_binary()))
                yield _batch(group=pa.array(t.names[t.group[where]]), phrase=text.cast(pa.large_string()).cast(pa.string()),
                             words=pa.array(np.full(len(where), size, dtype=np.int32)), n=pa.array(n.astype(np.int64)))
    return run


# --- passes -----------------------------------------------------------------------------

def _bitmap(df: DataFrame, hashes: Column):
    """A broadcast bitmap of ``1 << BITS`` bits with the highest bits of the hashes set."""
    spark, place = df.sparkSession, F.shiftrightunsigned(hashes, 64 - BITS)
    parts = df.select(place.alias("place")).groupBy(F.shiftright("place", 15).alias("part")).agg(
        F.bitmap_construct_agg(F.col("place").bitwiseAND(F.lit(32_767))).alias("bits"))
    out = bytearray(1 << BITS - 3)
    for row in parts.collect():  # at most 1 << (BITS - 15) rows of 4 KB
        out[row["part"] << 12:(row["part"] << 12) + len(row["bits"])] = row["bits"]
    return spark.sparkContext.broadcast(bytes(out))


def counts(docs: DataFrame, text: str = "text", lang: str = "lang", support: int = SUPPORT, longest: int = LONGEST,
           shards: int = SHARDS) -> tuple[DataFrame, DataFrame]:
    """``lang, phrase, words, n`` of all phrases of up to ``longest`` words with the support, and ``lang, total`` words."""
    spark = docs.sparkSession
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = docs.select(whole.alias("text"), F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"),
                       F.pmod(F.xxhash64(whole, F.lit(SEED)), F.lit(shards)).cast("int").alias("shard"))
    local_name, global_name = F.xxhash64("lang", "shard"), F.xxhash64("lang")
    # languages are few: one row per language and shard
    names = settle(rows.select("lang", "shard").distinct().select("lang", "shard", local_name.alias("group"), global_name.alias("all")), "phrase-groups")
    listed = names.collect()
    own, every = {r["group"]: r["group"] for r in listed}, {r["all"]: r["all"] for r in listed}
    local, overall = rows.select("text", local_name.alias("group")), rows.select("text", global_name.alias("group"))
    # words are counted as they are, by shard: their totals serve the support and the scores
    words = settle(local.mapInArrow(_word_counts, "group bigint, phrase string, n bigint").groupBy("group", "phrase").agg(F.sum("n").alias("n")), "phrase-words")
    per = settle(words.groupBy("group").agg(F.sum("n").alias("part")).join(names, "group"), "phrase-sizes")
    totals = settle(per.groupBy("lang", "all").agg(F.sum("part").alias("total")), "phrase-totals")
    least = settle(per.join(totals.select("all", "total"), "all").select(
        "group", "all", F.ceil(F.lit(support) * F.col("part").cast("decimal(20,0)") / F.col("total")).cast("bigint").alias("least")), "phrase-support")
    least = measured(least)
    frequent = words.join(least, "group").where("n >= least").select(F.xxhash64("phrase").alias("hash"), "group")
    known, candidates = _bitmap(frequent, F.col("hash").bitwiseXOR(F.col("group"))), []
    for size in range(2, longest + 1):
        mined = local.mapInArrow(_local(size, known, own), "group bigint, hash bigint, n bigint").groupBy("group", "hash").agg(F.sum("n").alias("n"))
        frequent = settle(mined.join(least, "group").where("n >= least").select("hash", "group", "all"), f"phrase-local-{size}")
        known = _bitmap(frequent, F.col("hash").bitwiseXOR(F.col("group")))
        candidates.append(_bitmap(frequent, F.col("hash").bitwiseXOR(F.col("all"))))
    singles = words.join(measured(settle(names.select("group", "lang"), "phrase-names")), "group").groupBy("lang", "phrase").agg(F.sum("n").alias("n")).select(
        "lang", "phrase", F.lit(1).alias("words"), "n")
    langs = measured(settle(names.select(F.col("all").alias("group"), "lang").distinct(), "phrase-langs"))
    longer = overall.mapInArrow(_counted(longest, candidates, every), "group bigint, phrase string, words int, n bigint").groupBy(
        "group", "phrase", "words").agg(F.sum("n").alias("n")).where(F.col("n") >= support).join(langs, "group").select("lang", "phrase", "words", "n")
    found = settle(singles.where(F.col("n") >= support).unionByName(longer), "phrase-counts")
    return found, totals.select("lang", "total")


def scored(found: DataFrame) -> DataFrame:
    """``lang, phrase, words, a, l, r, score`` of phrases of two words or more, by their lowest-scoring cut."""
    parts = F.split("phrase", " ")
    cut = found.where("words > 1").select(
        "lang", "phrase", "words", F.col("n").alias("a"), F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k")).withColumns({
            "first": F.concat_ws(" ", F.slice(parts, F.lit(1), F.col("k"))), "rest": F.concat_ws(" ", F.slice(parts, F.col("k") + 1, F.col("words") - F.col("k")))})
    side = lambda name, n: found.select(F.col("lang").alias(f"{n}_lang"), F.col("phrase").alias(f"{n}_phrase"), F.col("n").alias(n))
    met = cut.join(side("first", "l"), (F.col("lang") == F.col("l_lang")) & (F.col("first") == F.col("l_phrase"))).join(
        side("rest", "r"), (F.col("lang") == F.col("r_lang")) & (F.col("rest") == F.col("r_phrase")))
    wide = lambda c: f"cast({c} as decimal(15,0))"  # noqa: E731  counts below 10^15: the products stay exact
    score = F.expr(f"cast({SCALE} as decimal(7,0)) * ({wide('a')} * {wide('a')}) div ({wide('l')} * {wide('r')})")
    best = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("x")
    return met.groupBy("lang", "phrase", "words", "a").agg(best).select("lang", "phrase", "words", "a", "x.l", "x.r", "x.score")


def uncovered(found: DataFrame, percent: int = 50) -> DataFrame:
    """The phrases of two words or more that no longer phrase with at least ``percent`` of their count contains."""
    parts = F.split("phrase", " ")
    long = found.where("words > 2").withColumn("size", F.explode(F.sequence(F.lit(2), F.col("words") - 1))).withColumn(
        "from", F.explode(F.sequence(F.lit(1), F.col("words") - F.col("size") + 1)))
    inside = long.select(F.col("lang").alias("of_lang"), F.concat_ws(" ", F.slice(parts, F.col("from"), F.col("size"))).alias("of_phrase"), "n").groupBy(
        "of_lang", "of_phrase").agg(F.max("n").alias("most"))
    met = found.where("words > 1").join(inside, (F.col("lang") == F.col("of_lang")) & (F.col("phrase") == F.col("of_phrase")), "left")
    return met.where(F.coalesce(F.col("most") * 100 < F.col("n") * percent, F.lit(True))).select("lang", "phrase")


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", top: int = 2000, support: int = SUPPORT,
                 longest: int = LONGEST, shards: int = SHARDS, percent: int = 50) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the ``top`` phrases of each language."""
    found, totals = counts(docs, text, lang, support, longest, shards)
    left = scored(found).join(uncovered(found, percent), ["lang", "phrase"], "left_semi")
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    # tasks keep no more than ``top`` rows of a language before the shuffle
    ranked = left.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.join(measured(settle(totals, "phrase-n")), "lang").select(
        "lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", F.col("total").alias("n"), "score")
