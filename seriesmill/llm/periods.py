"""Periodic runs of words by internal pattern matching.

A run of period q and at least four periods holds a block of 2^k words, 2^k <= q < 2^(k+1), that starts at a
multiple of 2^k and occurs again q words later.  So for every k each such (dyadic) block is looked up in the window
of starts 2^k to 2^(k+1) - 1 words behind it:

* a suffix array of the words, sorted by doubling, has the occurrences of a block side by side;
* a wavelet tree over it counts the occurrences before a position and finds the next one in logarithmic time
  (range successor), for all blocks at once;
* occurrences of a block that start within its length form an arithmetic progression, so the first one, the last
  one and their number give all candidate periods of the block.

Successive blocks with one candidate are joined, and the sorted ranks of all powers of two extend the stretch
to both sides.  Several texts are looked at together, parted by marks that occur once, until they have ``TOGETHER``
words; a longer text is looked at alone, in memory of about 8 bytes a word and level of the suffix array.

Defined results
    words are runs of characters other than space and tab to carriage return; null text has no words; a run has
    at least 6 words and 4 periods, its period is the smallest, and no neighbouring word extends it; runs are
    in the order of start and period; rows without id and repeated rows are rows like others; further columns
    are passed over; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

TOGETHER = 1 << 16
PERIODS, WORDS = 4, 6


# --- suffix array and wavelet tree --------------------------------------------------------

def suffix_ranks(codes: np.ndarray) -> tuple[np.ndarray, list[np.ndarray], list[np.ndarray]]:
    """The suffix array, and for each k the rank of the 2^k codes from every place on and the size of each rank.

    A rank is the first place in the suffix array of the suffixes that start alike; sizes stand at that place.
    The last code occurs once.
    """
    n = len(codes)
    order = np.argsort(codes, kind="stable")
    head = np.concatenate([[True], codes[order][1:] != codes[order][:-1]])
    rank = np.empty(n, dtype=np.int32)
    rank[order] = np.flatnonzero(head)[np.cumsum(head) - 1]
    ranks, sizes, width = [rank], [_sizes(head)], 1
    while True:
        alike = sizes[-1][rank[order]] > 1
        slots = np.flatnonzero(alike)
        if not len(slots):
            return order, ranks, sizes
        left = order[slots]
        first, second = rank[left], rank[np.minimum(left + width, n - 1)]
        by = np.argsort(first.astype(np.int64) * n + second, kind="stable")
        left, first, second = left[by], first[by], second[by]
        order[slots] = left
        new = np.concatenate([[True], (first[1:] != first[:-1]) | (second[1:] != second[:-1])])
        head[slots] = new
        rank = rank.copy()
        rank[left] = slots[new][np.cumsum(new) - 1]
        ranks.append(rank)
        sizes.append(_sizes(head))
        width *= 2


def _sizes(head: np.ndarray) -> np.ndarray:
    at = np.flatnonzero(head)
    out = np.zeros(len(head), dtype=np.int32)
    out[at] = np.diff(np.concatenate([at, [len(head)]]))
    return out


class WaveletTree:
    """Counts and order statistics of the values in any range of an array of numbers below its length."""

    def __init__(self, values: np.ndarray):
        self.bits = max(1, int(len(values) - 1).bit_length())
        self.ones: list[np.ndarray] = []
        self.zeros: list[int] = []
        for level in reversed(range(self.bits)):
            bit = (values >> level & 1).astype(np.int32)
            self.ones.append(np.concatenate([[0], np.cumsum(bit, dtype=np.int32)]))
            self.zeros.append(int(len(bit) - bit.sum()))
            values = np.concatenate([values[bit == 0], values[bit == 1]])

    def below(self, low: np.ndarray, high: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """How many values in ``[low, high)`` are less than ``bound``."""
        found = np.where(bound >= 1 << self.bits, high - low, 0)
        for k, (ones, zeros) in enumerate(zip(self.ones, self.zeros)):
            one = (bound >> (self.bits - 1 - k) & 1).astype(bool)
            a, b = ones[low], ones[high]
            found = found + np.where(one & (bound < 1 << self.bits), (high - low) - (b - a), 0)
            low, high = np.where(one, zeros + a, low - a), np.where(one, zeros + b, high - b)
        return found

    def smallest(self, low: np.ndarray, high: np.ndarray, k: np.ndarray) -> np.ndarray:
        """The value of rank ``k`` (from 0) in ``[low, high)``."""
        value = np.zeros(len(low), dtype=np.int64)
        for ones, zeros in zip(self.ones, self.zeros):
            a, b = ones[low], ones[high]
            none = (high - low) - (b - a)
            one = k >= none
            k = np.where(one, k - none, k)
            value = value * 2 + one
            low, high = np.where(one, zeros + a, low - a), np.where(one, zeros + b, high - b)
        return value


# --- runs ---------------------------------------------------------------------------------

def candidates(k: int, rank: np.ndarray, size: np.ndarray, tree: WaveletTree) -> tuple[np.ndarray, np.ndarray]:
    """Dyadic blocks of 2^k words (by start) and the periods from 2^k to 2^(k+1) - 1 at which they occur again."""
    width = 1 << k
    block = np.arange(0, len(rank), width, dtype=np.int64)
    block = block[size[rank[block]] > 1]
    low = rank[block].astype(np.int64)
    high = low + size[rank[block]]
    before, upto = tree.below(low, high, block + width), tree.below(low, high, block + 2 * width)
    hit = upto > before
    block, low, high, before, upto = (v[hit] for v in (block, low, high, before, upto))
    first, last, times = tree.smallest(low, high, before), tree.smallest(low, high, upto - 1), upto - before
    step = (last - first) // np.maximum(times - 1, 1)
    # where the progression reaches back to the block itself, its step is a smaller period
    own = before - tree.below(low, high, block)
    keep = (times == 1) | (own * step != first - block)
    block, first, step, times = block[keep], first[keep], step[keep], times[keep]
    at = np.repeat(np.arange(len(block)), times)
    turn = np.arange(len(at)) - np.repeat(np.cumsum(times) - times, times)
    return block[at], first[at] - block[at] + turn * step[at]


def runs(codes: np.ndarray) -> np.ndarray:
    """Rows ``start, length, period`` of all runs, by start and period; codes that occur once part the texts."""
    order, ranks, sizes = suffix_ranks(codes)
    tree, found = WaveletTree(order), []
    for k in range(len(ranks)):
        block, period = candidates(k, ranks[k], sizes[k], tree)
        if not len(block):
            continue
        by = np.lexsort((block, period))
        block, period = block[by], period[by]
        joins = np.concatenate([[False], (period[1:] == period[:-1]) & (block[1:] == block[:-1] + (1 << k))])
        cuts = np.flatnonzero(~joins)
        begin, period = block[cuts], period[cuts]
        end = block[np.concatenate([cuts[1:], [len(block)]]) - 1] + (1 << k)
        # a run repeats three periods of words; a block more on each side at most is still to be seen
        near = end - begin + (2 << k) >= (PERIODS - 1) * period
        begin, end, period = begin[near], end[near], period[near]
        for t in reversed(range(len(ranks))):
            rank, width = ranks[t], 1 << t
            inside = end + period < len(codes)
            alike = inside & (rank[np.where(inside, end, 0)] == rank[np.where(inside, end + period, 0)])
            end = np.where(alike, end + width, end)
            inside = begin >= width
            alike = inside & (rank[np.where(inside, begin - width, 0)] == rank[np.where(inside, begin - width + period, 0)])
            begin = np.where(alike, begin - width, begin)
        length = end - begin + period
        good = length >= np.maximum(WORDS, PERIODS * period)
        found.append(np.stack([begin[good], length[good], period[good]], axis=1))
    rows = np.unique(np.concatenate([np.zeros((0, 3), dtype=np.int64), *found]), axis=0)  # by start, length and period
    if not len(rows):
        return rows
    rows = rows[np.concatenate([[True], (np.diff(rows[:, :2], axis=0) != 0).any(axis=1)])]  # the smallest period of a stretch
    return rows[np.lexsort((rows[:, 2], rows[:, 0]))]


def with_tail(n: int, g: int) -> np.ndarray:
    """Which word each of ``n`` words becomes when a periodic tail is put in by the number ``g``."""
    a = g % n
    period = 1 + (n - a) // (3 + g % 8)
    at = np.arange(n)
    return np.where(at < a, at, a + (at - a) % period)


# --- whole operator -----------------------------------------------------------------------

_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def _together(ids: list, words: list[list[bytes]], kind: pa.DataType) -> pa.RecordBatch:
    """``doc_id, runs, collapsed`` of some texts that are looked at as one."""
    begins = np.concatenate([[0], np.cumsum([len(w) + 1 for w in words])])
    coded = pa.array([x for w in words for x in (*w, b"")], pa.binary()).dictionary_encode()
    codes = coded.indices.to_numpy().astype(np.int64)
    codes[begins[1:] - 1] = len(coded.dictionary) + np.arange(len(words))  # marks that occur once
    rows = runs(codes)
    change = np.zeros(len(codes) + 1, dtype=np.int64)
    np.add.at(change, rows[:, 0] + rows[:, 2], 1)
    np.add.at(change, rows[:, 0] + rows[:, 1], -1)
    stays = np.cumsum(change) == 0
    cuts = np.searchsorted(rows[:, 0], begins)
    listed, text = [], []
    for k, w in enumerate(words):
        own = rows[cuts[k]:cuts[k + 1]]
        listed.append([{"start": a - int(begins[k]), "length": n, "period": p} for a, n, p in own.tolist()])
        text.append(b" ".join([x for x, s in zip(w, stays[begins[k]:begins[k + 1]].tolist()) if s] if len(own) else w))
    return pa.RecordBatch.from_arrays([pa.array(ids, kind), pa.array(listed, pa.list_(_RUN)), pa.array(text, pa.binary()).cast(pa.string())],
                                      ["doc_id", "runs", "collapsed"])


def collapsed(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", tail: str | None = None) -> DataFrame:
    """``doc_id, runs`` (array of start, length, period) and ``collapsed``: the words left when each run keeps its first period.

    Where the column ``tail`` has a number, a periodic tail is put into the text first (``with_tail``).
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list = []
        words: list[list[bytes]] = []
        held = 0
        for batch in batches:
            for name, body, g in zip(*(batch.column(k).to_pylist() for k in range(3))):
                found = (body or "").encode().split()
                if g is not None and found:
                    found = [found[k] for k in with_tail(len(found), g).tolist()]
                if words and held + len(found) > TOGETHER:
                    yield _together(ids, words, batch.schema.field(0).type)
                    ids, words, held = [], [], 0
                ids.append(name)
                words.append(found)
                held += len(found) + 1
            kind = batch.schema.field(0).type
        if words:
            yield _together(ids, words, kind)

    number = F.lit(None) if tail is None else F.col(tail)
    kind = docs.schema[doc_id].dataType.simpleString()
    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"), number.cast("bigint").alias("tail")).mapInArrow(
        run, f"doc_id {kind}, runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string")


def strongest(runs_: Column) -> Column:
    """Of runs in order the first one with the greatest length / period; null if there is none."""
    better = lambda b, r: b.isNull() | (r["length"] * b["period"] > b["length"] * r["period"])
    return F.aggregate(runs_, F.get(runs_, F.lit(0)), lambda b, r: F.when(better(b, r), r).otherwise(b))
