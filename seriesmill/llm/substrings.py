"""Long repeated substrings by suffix sorting: every byte that a string of ``length`` bytes covers which also starts elsewhere.

A suffix array of all texts is never built in one place.  Equal strings of ``length`` bytes (windows) are
brought together first, then sorted group by group:

1. Each window chooses the least hash among its 32-byte grams (leftmost of equals) as its anchor, so equal
   windows choose alike and successive windows mostly share an anchor.  The windows of an anchor fall into
   two ranges by their offset; the bytes all windows of a range share (its core) name a key.  Keys of one
   place only are dropped: most of any corpus leaves here, as 16 bytes for about 100 bytes of text.
2. The windows under a shared key that follow each other in a text form one stretch of bytes.  Equal
   stretches become one row with their number.  A key with one distinct stretch needs no sorting.
3. The distinct stretches of a key are sorted as one text in two stages: suffixes smaller than their
   successor are sorted directly, the others are induced by scanning the buckets of first bytes in order.
   Windows whose common prefix with their neighbour in the suffix array reaches ``length`` are repeated.
4. A key with more than ``CROWD`` distinct stretches is refined: its ranges are cut in four, so cores get
   longer and unlike stretches part, while stretches that stay alike become equal rows.  At a width of
   one a core is the window itself and the count of its places decides.  No task sees an unbounded group.

Defined results
    texts are UTF-8 bytes; null text is empty; matches do not cross texts; overlaps count (a text may repeat
    itself); a text shorter than ``length`` repeats nothing; of equal texts of ``length`` or more bytes
    nothing stays; rows without id and repeated rows are rows like others; further columns are passed over; an
    empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from seriesmill.llm.common import measured, settle

LENGTH, GRAM, SEED = 400, 32, 42
#: Most distinct stretches that are sorted under one key; bytes that are sorted in one go; bytes dealt to a task.
CROWD, SORTED, DEALT = 256, 1 << 19, 1 << 21
#: Windows of one text that are looked at in one go.
PART = 1 << 20
_random = np.random.default_rng(13)
_BYTE = _random.integers(0, 1 << 64, 256, dtype=np.uint64)
_TIMES = _random.integers(0, 1 << 64, 8, dtype=np.uint64) | np.uint64(1)


# --- suffix arrays ----------------------------------------------------------------------

def suffix_array(text: np.ndarray, depth: int) -> np.ndarray:
    """Positions of all suffixes, sorted by their first ``depth`` bytes at least, in two stages.

    ``text`` holds unsigned bytes.  A suffix is small if it is less than its successor (the last one is small).
    """
    n = len(text)
    if not n:
        return np.zeros(0, dtype=np.int64)
    step = np.sign(np.diff(text.astype(np.int16)))
    step = np.concatenate([step, [1]])
    turns = np.flatnonzero(step)  # in a run of equal bytes the end of the run decides
    small = step[turns[np.searchsorted(turns, np.arange(n))]] > 0
    raw, chosen = text.tobytes(), np.flatnonzero(small)
    direct = np.array(sorted(chosen.tolist(), key=lambda i: raw[i:i + depth]), dtype=np.int64)
    firsts = text[direct]
    starts = np.searchsorted(firsts, np.arange(257))
    waiting: list[list[np.ndarray]] = [[] for _ in range(256)]
    out: list[np.ndarray] = []
    for c in np.unique(text).tolist():
        layers, now = waiting[c], np.concatenate(waiting[c]) if waiting[c] else np.zeros(0, dtype=np.int64)
        layers, waiting[c] = [now], []
        while len(now):  # runs of c: what stands before a suffix of this bucket may fall into it too
            now = now[now > 0] - 1
            now = now[text[now] == c]
            layers.append(now)
        bucket = np.concatenate([*layers, direct[starts[c]:starts[c + 1]]])
        out.append(bucket)
        before = bucket[bucket > 0] - 1
        larger = text[before] > c
        before = before[larger]
        if len(before):
            by = text[before]
            order = np.argsort(by, kind="stable")
            before, by = before[order], by[order]
            cuts = np.flatnonzero(np.diff(by)) + 1
            for part in np.split(before, cuts):
                waiting[int(text[part[0]])].append(part)
    return np.concatenate(out)


def repeated_starts(pieces: list[bytes], length: int = LENGTH) -> list[np.ndarray]:
    """For every piece the starts of its windows that also start elsewhere in the pieces, ascending."""
    sizes = np.array([len(p) for p in pieces])
    begins = np.concatenate([[0], np.cumsum(sizes + 1)])
    text = np.zeros(begins[-1], dtype=np.uint8)  # UTF-8 has no byte 255: bytes move up by one, 0 parts the pieces
    for piece, at in zip(pieces, begins.tolist()):
        text[at:at + len(piece)] = np.frombuffer(piece, dtype=np.uint8) + 1
    room = np.repeat(begins[1:] - 1, sizes + 1) - np.arange(len(text))
    order = suffix_array(text, length)
    order = order[room[order] >= length]
    raw, places = text.tobytes(), order.tolist()
    same = np.array([raw[a:a + length] == raw[b:b + length] for a, b in zip(places, places[1:])], dtype=bool)
    hit = np.zeros(len(text), dtype=bool)
    hit[order[:-1][same]] = hit[order[1:][same]] = True
    found = np.flatnonzero(hit)
    cuts = np.searchsorted(found, begins)
    return [found[a:b] - at for a, b, at in zip(cuts[:-1], cuts[1:], begins)]


# --- anchors ----------------------------------------------------------------------------

def anchors(raw: bytes, length: int = LENGTH, gram: int = GRAM) -> np.ndarray:
    """Rows ``anchor, first window, last window``: the windows (by start) that choose the anchor, each window once."""
    parts = []
    for begin in range(0, len(raw) - length + 1, PART):
        x = _BYTE[np.frombuffer(raw, dtype=np.uint8)[begin:begin + PART + length - 1]]
        width, k = 1, 0
        while width < gram:  # hashes of twice the width from neighbours
            x = x[:-width] * _TIMES[k] + x[width:]
            width, k = 2 * width, k + 1
        x = (x ^ (x >> np.uint64(29))) * _TIMES[7]
        # least hash and leftmost place in one number
        x = (x >> np.uint64(26) << np.uint64(26)) | np.arange(len(x), dtype=np.uint64)
        grams, width = length - gram + 1, 1
        while 2 * width <= grams:
            x = np.minimum(x[:-width], x[width:])
            width *= 2
        if width < grams:
            x = np.minimum(x[:width - grams], x[grams - width:])
        place = (x & np.uint64((1 << 26) - 1)).astype(np.int64)
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(place)) + 1, [len(place)]])
        parts.append(np.stack([place[cuts[:-1]], cuts[:-1], cuts[1:] - 1], axis=1) + begin)
    return np.concatenate(parts) if parts else np.zeros((0, 3), dtype=np.int64)


def widths(length: int = LENGTH, gram: int = GRAM) -> list[int]:
    """Widths of the ranges of offsets, from two ranges on, cut in four each time, down to one."""
    out = [-(-(length - gram + 1) // 2)]
    while out[-1] > 1:
        out.append(-(-out[-1] // 4))
    return out


def stretches(anchor: int, first: int, last: int, width: int, length: int) -> Iterator[tuple[int, int, int, int, int]]:
    """The ranges that the windows ``first`` to ``last`` fall into: number, their first and last window, the core."""
    for j in range((anchor - last) // width, (anchor - first) // width + 1):
        high = anchor - j * width
        low = high - width + 1
        yield j, max(first, low), min(last, high), high, low + length


def keyed_stretches(raw: bytes, length: int = LENGTH) -> Iterator[tuple[int, int, int, int]]:
    """``key, first window, last window, anchor`` of a text; the key is the hash of a range and its core."""
    width = widths(length)[0]
    for anchor, first, last in anchors(raw, length).tolist():
        for j, a, b, begin, end in stretches(anchor, first, last, width, length):
            yield _signed(xxhash.xxh64_intdigest(raw[begin:end], SEED + j)), a, b, anchor


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``key, mark, twice``: the distinct keys of each text and whether it has the key at two places."""
    for batch in batches:
        for mark, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            found = np.array([key for key, *_ in keyed_stretches((text or "").encode())], dtype=np.int64)
            if len(found):
                key, times = np.unique(found, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(np.full(len(key), mark, dtype=np.int64)), pa.array(times > 1)], ["key", "mark", "twice"])


def _stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The distinct stretches of each text under its shared keys, with the starts where they lie."""
    for batch in batches:
        rows: dict[str, list] = {n: [] for n in ("key", "piece", "body", "lead", "mark", "starts", "n")}
        for mark, text, keys in zip(*(batch.column(k).to_pylist() for k in range(3))):
            raw, wanted, seen = text.encode(), set(keys), {}
            for key, a, b, anchor in keyed_stretches(raw):
                if key in wanted:
                    seen.setdefault((key, raw[a:b + LENGTH], anchor - a), []).append(a)
            for (key, body, lead), starts in seen.items():
                for name, value in zip(rows, (key, hashlib.md5(body).digest(), body, lead, mark, starts, len(starts))):
                    rows[name].append(value)
        yield pa.RecordBatch.from_pydict(rows, pa.schema([
            ("key", pa.int64()), ("piece", pa.binary()), ("body", pa.binary()), ("lead", pa.int32()), ("mark", pa.binary()),
            ("starts", pa.list_(pa.int64())), ("n", pa.int64())]))


# --- sorting ----------------------------------------------------------------------------

def _runs(starts: np.ndarray) -> list[dict[str, int]]:
    """Ascending numbers as ranges with both ends included."""
    if not len(starts):
        return []
    cuts = np.flatnonzero(np.diff(starts) != 1) + 1
    return [{"low": int(p[0]), "high": int(p[-1])} for p in np.split(starts, cuts)]


def _sorted_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Repeated windows of the stretches, over rows sorted by key; whole keys are sorted together."""
    keys: list[int] = []
    pieces: list[bytes] = []
    bodies: list[bytes] = []
    held = 0

    def flush(upto: int) -> pa.RecordBatch:
        hits = [(k, p, _runs(s)) for k, p, s in zip(keys[:upto], pieces[:upto], repeated_starts(bodies[:upto])) if len(s)]
        del keys[:upto], pieces[:upto], bodies[:upto]
        return pa.RecordBatch.from_pydict(
            {"key": [h[0] for h in hits], "piece": [h[1] for h in hits], "hits": [h[2] for h in hits]},
            pa.schema([("key", pa.int64()), ("piece", pa.binary()), ("hits", pa.list_(pa.struct([("low", pa.int64()), ("high", pa.int64())])))]))

    for batch in batches:
        for key, piece, body in zip(*(batch.column(k).to_pylist() for k in range(3))):
            if held >= SORTED and keys and key != keys[-1]:
                yield flush(len(keys))
                held = 0
            keys.append(key)
            pieces.append(piece)
            bodies.append(body)
            held += len(body)
    if keys:
        yield flush(len(keys))


def _finer(width: int):
    """Cuts stretches into ranges of ``width`` offsets; ``shift`` is where a part begins in its stretch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: dict[str, list] = {n: [] for n in ("key", "piece", "body", "lead", "n", "of_key", "of_piece", "shift")}
            for key, piece, body, lead, n in zip(*(batch.column(k).to_pylist() for k in range(5))):
                for j, a, b, begin, end in stretches(lead, 0, len(body) - LENGTH, width, LENGTH):
                    part = body[a:b + LENGTH]
                    name = _signed(xxhash.xxh64_intdigest(body[begin:end] + key.to_bytes(8, "little", signed=True), SEED + j))
                    for to, value in zip(rows, (name, hashlib.md5(part).digest(), part, lead - a, n, key, piece, a)):
                        rows[to].append(value)
            yield pa.RecordBatch.from_pydict(rows, pa.schema([
                ("key", pa.int64()), ("piece", pa.binary()), ("body", pa.binary()), ("lead", pa.int32()), ("n", pa.int64()),
                ("of_key", pa.int64()), ("of_piece", pa.binary()), ("shift", pa.int64())]))
    return run


_HITS = "array<struct<low: bigint, high: bigint>>"


def _repeated(rows: DataFrame, level: int, crowd: int) -> DataFrame:
    """``key, piece, hits``: the repeated windows of every distinct stretch of ``rows`` (``key, piece, body, lead, n``)."""
    distinct = settle(rows.groupBy("key", "piece").agg(
        F.any_value("body").alias("body"), F.any_value("lead").alias("lead"), F.sum("n").alias("n")), f"stretches-{level}")
    kinds = distinct.groupBy("key").agg(F.count(F.lit(1)).alias("kinds")).where("kinds > 1").withColumnRenamed("key", "of")
    every = F.array(F.struct(F.lit(0).cast("bigint").alias("low"), (F.length("body") - LENGTH).cast("bigint").alias("high")))
    whole = distinct.where("n > 1").select("key", "piece", every.alias("hits"))  # at several places as a whole
    several = settle(distinct.join(kinds, F.col("key") == F.col("of")).drop("of"), f"several-{level}")
    fits = several.where(F.col("kinds") <= crowd).select("key", "piece", "body")
    # as many tasks as the bytes need: sorting costs far more than reading
    tasks = max(1, -(-int(fits.agg(F.sum(F.length("body"))).first()[0] or 0) // DEALT))
    found = whole.unionByName(fits.repartition(tasks, "key").sortWithinPartitions("key").mapInArrow(
        _sorted_groups, f"key bigint, piece binary, hits {_HITS}"))
    crowded = several.where(F.col("kinds") > crowd)
    if not crowded.limit(1).count():
        return found
    finer = settle(crowded.select("key", "piece", "body", "lead", "n").mapInArrow(
        _finer(widths()[level + 1]), "key bigint, piece binary, body binary, lead int, n bigint, of_key bigint, of_piece binary, shift bigint"),
        f"finer-{level}")
    below = _repeated(finer.select("key", "piece", "body", "lead", "n"), level + 1, crowd).select(
        F.col("key").alias("k"), F.col("piece").alias("p"), "hits")
    back = finer.select("key", "piece", "of_key", "of_piece", "shift").join(
        below, (F.col("key") == F.col("k")) & (F.col("piece") == F.col("p"))).select(
        F.col("of_key").alias("key"), F.col("of_piece").alias("piece"),
        F.transform("hits", lambda h: F.struct((h["low"] + F.col("shift")).alias("low"), (h["high"] + F.col("shift")).alias("high"))).alias("hits"))
    return found.unionByName(back)


# --- whole operator ---------------------------------------------------------------------

def _named(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    return docs.select(F.col(doc_id).alias("doc_id"), whole.alias("text"), F.unhex(F.md5(whole)).alias("mark"))


def repeated_spans(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", crowd: int = CROWD) -> DataFrame:
    """``mark`` (MD5 of a text), ``spans``: the ranges of repeated windows (starts, not merged) of texts that have some.

    Texts are looked at once each; ``copies`` of ``texts`` tells of equal ones.
    """
    named = _named(docs, doc_id, text)
    keys = settle(named.select(F.xxhash64("mark").alias("mark"), "text").mapInArrow(_keys, "key bigint, mark bigint, twice boolean"), "anchor-keys")
    shared = keys.groupBy("key").agg(F.min("mark").alias("low"), F.max("mark").alias("high"), F.bool_or("twice").alias("twice")).where(
        "low <> high or twice").select(F.col("key").alias("of"))
    wanted = keys.select("key", "mark").distinct().join(shared, F.col("key") == F.col("of")).groupBy("mark").agg(F.collect_list("key").alias("keys"))
    # of equal texts one is looked at; a null id is the least
    first = named.groupBy("mark").agg(F.min(F.struct("doc_id")).alias("x")).select(F.col("mark").alias("of_mark"), F.col("x.doc_id").alias("of_id"))
    asked = settle(first.join(wanted, F.xxhash64("of_mark") == F.col("mark")).select("of_mark", "of_id", "keys"), "anchor-texts")
    met = named.join(asked, (F.col("mark") == F.col("of_mark")) & F.col("doc_id").eqNullSafe(F.col("of_id"))).select("mark", "text", "keys")
    found = settle(met.mapInArrow(
        _stretches, "key bigint, piece binary, body binary, lead int, mark binary, starts array<bigint>, n bigint"), "stretches")
    hits = _repeated(found.select("key", "piece", "body", "lead", "n"), 0, crowd).select(
        F.col("key").alias("k"), F.col("piece").alias("p"), F.explode("hits").alias("hit"))
    places = found.select("key", "piece", "mark", F.explode("starts").alias("at")).join(hits, (F.col("key") == F.col("k")) & (F.col("piece") == F.col("p")))
    return places.groupBy("mark").agg(F.collect_set(F.struct((F.col("at") + F.col("hit.low")).alias("low"), (F.col("at") + F.col("hit.high")).alias("high"))).alias("spans"))


def merged(spans: list[dict[str, int]] | None, length: int) -> list[tuple[int, int]]:
    """Byte ranges (end excluded) that windows starting in the ``spans`` cover; touching ranges become one."""
    out: list[tuple[int, int]] = []
    for low, high in sorted((s["low"], s["high"] + length) for s in spans or ()):
        if out and low <= out[-1][1]:
            out[-1] = (out[-1][0], max(high, out[-1][1]))
        else:
            out.append((low, high))
    return out


def without_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", crowd: int = CROWD) -> DataFrame:
    """``doc_id, n_bytes, removed`` (byte ranges, end excluded) and ``kept`` (the bytes left) of every row."""
    named = _named(docs, doc_id, text)
    copies = named.groupBy("mark").agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")
    spans = repeated_spans(docs, doc_id, text, crowd)
    known = settle(copies.join(spans.withColumnRenamed("mark", "m"), F.col("mark") == F.col("m"), "full").select(
        F.coalesce("mark", "m").alias("of_mark"), F.coalesce("copies", F.lit(1)).alias("copies"),
        F.when(F.col("copies").isNull(), F.col("spans")).alias("spans")), "repeats")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, ranges, kept = [], [], []
            for body, copies, spans in zip(*(batch.column(k).to_pylist() for k in (1, 2, 3))):
                raw = body.encode()
                gone = merged(spans, LENGTH) if copies == 1 else [(0, len(raw))] if len(raw) >= LENGTH else []
                ends = [0, *(x for r in gone for x in r), len(raw)]
                sizes.append(len(raw))
                ranges.append([{"begin": a, "end": b} for a, b in gone])
                kept.append(b"".join(raw[a:b] for a, b in zip(ends[::2], ends[1::2])))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(ranges, pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))),
                 pa.array(kept, pa.binary())], ["doc_id", "n_bytes", "removed", "kept"])

    met = named.join(measured(known), F.col("mark") == F.col("of_mark"), "left").select(
        "doc_id", "text", F.coalesce("copies", F.lit(1)).alias("copies"), "spans")
    kind = docs.schema[doc_id].dataType.simpleString()
    return met.mapInArrow(run, f"doc_id {kind}, n_bytes bigint, removed array<struct<begin: bigint, end: bigint>>, kept binary")
