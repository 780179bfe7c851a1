"""SimHash near-duplicates through pivot distance tables.

Every fingerprint gets a row of Hamming distances to fixed reference fingerprints (pivots).
Two fingerprints within distance r differ by r at most in every coordinate, so a pair whose
largest coordinate difference is above r is discarded without a look at the bits; survivors
are verified.

The table also says which pairs to look at.  Pivots that lie inside one half-byte, taken
relative to the zero pivot, depend on these four bits only.  The half-bytes are dealt to
four blocks; two differing bits touch two blocks at most, so the pair agrees in all
coordinates of the other two.  Six keys per fingerprint (one for each pair of blocks) hence
find every pair.  A key shared by more than ``crowd`` fingerprints is refined: the two open
blocks are cut into four again, which gives six finer keys; after two refinements only eight
bits are open and no key can be shared by more than 256 fingerprints.

Defined results
    words are runs of characters other than space and tab to carriage return; letters A-Z are
    lower-cased; null text has no words; no words give fingerprint zero, which links like any
    other; equal fingerprints are one node, so copies never meet in pairs; further columns
    are passed over; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations, repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from seriesmill.llm.common import settle, unused
from seriesmill.llm.components import components

RADIUS, SHINGLE, SEED = 2, 3, 42
#: Most fingerprints that are compared under one key; 256 at least.
CROWD = 1024
#: Pairs that are looked at in one go.
PAIRS = 1 << 20


def _references() -> np.ndarray:
    """Wide random pivots first, then the zero pivot, then four pivots inside each half-byte."""
    wide = np.random.default_rng(64).integers(0, 1 << 64, 16, dtype=np.uint64)
    inside = [p << (4 * h) for h in range(16) for p in (0b1111, 0b0101, 0b0011, 0b1001)]
    return np.concatenate([wide, np.zeros(1, np.uint64), np.array(inside, dtype=np.uint64)])


PIVOTS = _references()
WIDE = 16
_MIX = np.random.default_rng(4).integers(0, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def distances(prints: np.ndarray) -> np.ndarray:
    """The pivot distance table of unsigned fingerprints."""
    return np.bitwise_count(prints[:, None] ^ PIVOTS[None, :]).astype(np.int16)


# --- fingerprints -----------------------------------------------------------------------

def fingerprint(text: str | None, size: int = SHINGLE) -> int:
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    line, ends = b" ".join(words), np.cumsum([len(w) + 1 for w in words]) - 1
    if len(words) <= size:
        hashes = [xxhash.xxh64_intdigest(line, SEED)]
    else:
        starts = np.concatenate([[0], ends[:-size] + 1]).tolist()
        hashes = list(map(xxhash.xxh64_intdigest, [line[a:b] for a, b in zip(starts, ends[size - 1:].tolist())], repeat(SEED)))
    ones = np.zeros(64, dtype=np.int64)
    for begin in range(0, len(hashes), 65_536):
        part = np.array(hashes[begin:begin + 65_536], dtype="<u8")
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, mark, print``: a hash and the fingerprint of every whole text, as signed longs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.array([fingerprint(t) for t in batch.column(2).to_pylist()], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(values, pa.int64())], ["doc_id", "mark", "print"])

    return docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.xxhash64(F.col(text)).alias("mark"),
                       F.col(text).cast("string").alias("text")).mapInArrow(run, "doc_id bigint, mark bigint, print bigint")


# --- keys -------------------------------------------------------------------------------

def _blocks(open_: tuple[int, ...]) -> list[tuple[int, ...]]:
    width = len(open_) // 4
    return [open_[i * width:(i + 1) * width] for i in range(4)]


def _keys(batch: pd.DataFrame) -> Iterator[pd.DataFrame]:
    """Finer keys for rows of ``key, open, print``; ``open`` has a bit for each half-byte not fixed yet."""
    for mask, rows in batch.groupby("open", sort=True):
        half_bytes = tuple(h for h in range(16) if mask >> h & 1)
        prints = rows["print"].to_numpy().view(np.uint64)
        table = distances(prints)
        relative = (table[:, WIDE + 1:] - table[:, WIDE:WIDE + 1]).astype(np.int64).view(np.uint64) * _MIX
        blocks = [relative[:, [4 * h + j for h in b for j in range(4)]].sum(axis=1, dtype=np.uint64) for b in _blocks(half_bytes)]
        for first, second in combinations(range(4), 2):
            left = tuple(h for i, b in enumerate(_blocks(half_bytes)) if i not in (first, second) for h in b)
            key = (rows["key"].to_numpy().view(np.uint64) + np.uint64(4 * first + second + 1)) * _MIX[0]
            key ^= (blocks[first] * _MIX[1]) ^ (blocks[second] * _MIX[2])
            yield pd.DataFrame({"key": (key ^ (key >> np.uint64(29))).view(np.int64),
                                "open": np.int32(sum(1 << h for h in left)), "print": rows["print"].to_numpy()})


def _finer(rows: DataFrame) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield from _keys(batch)
    return rows.select("key", "open", "print").mapInPandas(run, "key bigint, open int, print bigint")


# --- pairs under one key ----------------------------------------------------------------

def _forest(n: int, a: np.ndarray, b: np.ndarray, root: np.ndarray) -> np.ndarray:
    """Roots of 0..n-1 after joining a and b, by minimum labels."""
    while True:
        low = np.minimum(root[a], root[b])
        before = root.copy()
        np.minimum.at(root, root[a], low)
        np.minimum.at(root, root[b], low)
        while True:
            jumped = root[root]
            if (jumped == root).all():
                break
            root = jumped
        if (root == before).all():
            return root


def linked(keys: np.ndarray, prints: np.ndarray, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """Links (each to the least fingerprint it is tied to) among rows sorted by key.

    Row i meets the rows up to its group's end at distance 1, 2, ... in the order of the rows.
    """
    n, table = len(keys), distances(prints)
    root, gap = np.arange(n), 1
    rows = np.arange(n)
    while True:
        rows = rows[rows + gap < n]
        rows = rows[keys[rows] == keys[rows + gap]]
        if not len(rows):
            break
        for begin in range(0, len(rows), PAIRS):
            a = rows[begin:begin + PAIRS]
            b = a + gap
            for p in range(table.shape[1]):  # largest coordinate difference, coordinate by coordinate
                near = np.abs(table[a, p] - table[b, p]) <= radius
                if not near.all():
                    a, b = a[near], b[near]
            sure = np.bitwise_count(prints[a] ^ prints[b]) <= radius
            if sure.any():
                root = _forest(n, a[sure], b[sure], root)
        gap += 1
    tied = np.nonzero(root != np.arange(n))[0]
    return prints[tied], prints[root[tied]]


def _link_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Over rows sorted by key: whole groups are linked, the last one waits for the next batch."""
    held: list[pd.DataFrame] = []

    def flush(rows: pd.DataFrame) -> pd.DataFrame:
        a, b = linked(rows["key"].to_numpy(), rows["print"].to_numpy().view(np.uint64))
        return pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)}).drop_duplicates()

    for batch in batches:
        if not len(batch):
            continue
        held.append(batch)
        last = batch["key"].iat[-1]
        if sum(map(len, held)) < 8 * CROWD:
            continue
        rows = pd.concat(held, ignore_index=True)
        done = int(np.searchsorted((rows["key"] == last).to_numpy(), True))
        held = [rows.iloc[done:]]
        if done:
            yield flush(rows.iloc[:done])
    if held:
        yield flush(pd.concat(held, ignore_index=True))


def links(prints: DataFrame, crowd: int = CROWD) -> DataFrame:
    """Links ``a, b`` between distinct fingerprints that tie all pairs within the radius together."""
    if crowd < 256:
        raise ValueError("crowd must be 256 or more")
    rows = prints.select(F.lit(0).cast("bigint").alias("key"), F.lit(0xFFFF).alias("open"), "print").distinct()
    found = None
    for level in range(3):
        keyed = settle(_finer(rows), f"keys-{level}")
        counts = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").withColumnRenamed("key", "of")
        most = crowd if level < 2 else 1 << 62
        fits = keyed.join(counts.where(F.col("n") <= most), F.col("key") == F.col("of")).select("key", "print")
        part = fits.repartition("key").sortWithinPartitions("key", "print").mapInPandas(_link_batches, "a bigint, b bigint")
        found = part if found is None else found.unionByName(part)
        if level == 2 or not counts.where(F.col("n") > most).limit(1).count():
            return found
        rows = keyed.join(counts.where(F.col("n") > most), F.col("key") == F.col("of")).select("key", "open", "print")
    return found


def near_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, mark, print, component_id`` of every row; the component is the least id reachable by links."""
    prints = settle(fingerprints(docs, doc_id, text), "fingerprints")
    nodes = prints.groupBy("print").agg(F.min("doc_id").alias("least"))
    tied = components(links(prints.select("print")))
    named = nodes.join(tied, F.col("print") == F.col("node"), "left").select(
        F.col("print").alias("of"), F.coalesce("root", "print").alias("root"), "least")
    named = settle(named, "named")
    roots = named.groupBy("root").agg(F.min("least").alias("component_id"))
    by_print = named.join(roots, "root").select("of", "component_id")
    return prints.join(by_print, F.col("print") == F.col("of")).select("doc_id", "mark", "print", "component_id")


def representatives(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                    groups: Callable[[DataFrame, str, str], DataFrame] = near_groups) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns: of each component the one with its least id.

    ``groups`` gives ``doc_id, mark, component_id`` of every row.  Rows without an id stay unless they are linked to one with an id; of repeated rows one stays.
    """
    of, of_mark, mark = unused(docs.columns, "of", "of_mark", "mark")
    gone = groups(docs, doc_id, text).where(~F.col("doc_id").eqNullSafe(F.col("component_id"))).select(
        F.col("doc_id").alias(of), F.col("mark").alias(of_mark)).distinct()
    left = docs.withColumn(mark, F.xxhash64(F.col(text))).join(
        gone, F.col(doc_id).eqNullSafe(F.col(of)) & (F.col(mark) == F.col(of_mark)), "left_anti")
    return left.dropDuplicates([doc_id, mark]).select(*docs.columns)
