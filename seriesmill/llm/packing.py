"""Best-fit packing of pieces into sequences by a linear grouping scheme.

Lengths are whole numbers up to the sequence length, so what the plan must know is how many
pieces there are of each length: a table as long as the sequence, whatever the input.

1. Large lengths, sorted, are cut into groups of equal cardinality and rounded up to the
   largest of their group.
2. A linear program over configurations (multisets of rounded lengths that fit) is solved by
   column generation; the whole part of its solution is used.
3. The actual pieces take the places of their group, rank by rank, so the room left in every
   sequence is known.
4. Left-over large pieces and then the small ones, longest first, go to the sequence with the
   least room that holds them; a new one is opened if none does.

The plan is a list of runs: pieces of length L with ranks a, a+1, ... go to sequences s, s+1,
... at offset o.  Spark numbers the pieces of each length (a hot length is cut into slices)
and looks the run up.

Defined results
    lengths must be 1 to ``most``; repeated rows are packed each for itself; rows equal in id,
    piece and length are exchangeable; an empty table gives no sequence; columns named like an
    output column are replaced.
"""

from __future__ import annotations

from bisect import bisect_right
from collections import defaultdict

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from seriesmill.llm.common import running_before, settle, unused

#: Groups of large lengths, and the share of a sequence from which a length counts as large.
GROUPS, LARGE = 96, 1 / 3
#: Pieces of one length per slice when ranks are given.
SLICE_ROWS = 4_096
Run = tuple[int, int, int, int, int]  # length, first rank, pieces, first sequence, offset


def best_configuration(sizes: np.ndarray, values: np.ndarray, most: int) -> np.ndarray:
    """The multiset of sizes within ``most`` of highest value."""
    best = [np.zeros(most + 1)]
    for size, value in zip(sizes, values):
        row = best[-1].copy()
        if value > 1e-12:
            for _ in range(most // size):
                np.maximum(row[size:], row[:-size] + value, out=row[size:])
        best.append(row)
    counts, room = np.zeros(len(sizes)), most
    for k in range(len(sizes) - 1, -1, -1):
        while best[k + 1][room] > best[k][room] + 1e-12:
            counts[k] += 1
            room -= sizes[k]
            if room < sizes[k]:
                break
    return counts


def configurations(sizes: list[int], needed: list[int], most: int, rounds: int = 1500) -> list[tuple[np.ndarray, float]]:
    """Configurations and how often to use each, by column generation; fractional."""
    sizes_, right = np.array(sizes), np.array(needed, dtype=float)
    basis = np.diag([float(most // s) for s in sizes])
    for _ in range(rounds):
        inverse = np.linalg.inv(basis)
        amounts, prices = inverse @ right, inverse.sum(axis=0)
        column = best_configuration(sizes_, prices, most)
        if prices @ column <= 1 + 1e-7:
            break
        change = inverse @ column
        with np.errstate(divide="ignore", invalid="ignore"):
            ratios = np.where(change > 1e-9, np.maximum(amounts, 0) / change, np.inf)
        basis[:, int(np.argmin(ratios))] = column
    amounts = np.linalg.solve(basis, right)
    return [(basis[:, j].round().astype(int), float(a)) for j, a in enumerate(amounts) if a >= 1]


class Plan:
    """Builds the runs; open sequences are kept as stretches of equal room."""

    def __init__(self, most: int):
        self.most, self.runs, self.sequences = most, [], 0
        self.open: list[list[tuple[int, int]]] = [[] for _ in range(most + 1)]  # by room: first sequence, how many
        self.rooms: list[int] = []

    def add(self, first: int, count: int, room: int) -> None:
        if room and count:
            if not self.open[room]:
                self.rooms.insert(bisect_right(self.rooms, room), room)
            self.open[room].append((first, count))

    def fresh(self, count: int) -> int:
        first, self.sequences = self.sequences, self.sequences + count
        return first

    def fit(self, length: int, rank: int, count: int) -> None:
        """Best-fit ``count`` pieces of one length from ``rank`` on."""
        while count:
            at = bisect_right(self.rooms, length - 1)
            if at == len(self.rooms):
                needed = -(-count // (self.most // length))
                self.add(self.fresh(needed), needed, self.most)
                continue
            room = self.rooms[at]
            first, there = self.open[room].pop()
            if not self.open[room]:
                self.rooms.pop(at)
            used = min(there, count)
            self.runs.append((length, rank, used, first, self.most - room))
            self.add(first, used, room - length)
            self.add(first + used, there - used, room)
            rank, count = rank + used, count - used


def plan(counts: dict[int, int], most: int, groups: int = GROUPS, large: float = LARGE) -> list[Run]:
    """Runs for ``counts`` pieces of each length."""
    out = Plan(most)
    if counts.get(most):
        out.runs.append((most, 0, counts[most], out.fresh(counts[most]), 0))
    lengths = sorted((n for n in counts if n < most and counts[n]), reverse=True)
    big = [n for n in lengths if n > most * large]
    # ranks over all large pieces, longest first: where each length starts
    starts, total = [], 0
    for n in big:
        starts.append(total)
        total += counts[n]

    def lengths_of(first: int, count: int):
        """Stretches (length, first rank in the length, pieces) of a stretch of ranks."""
        while count:
            k = bisect_right(starts, first) - 1
            part = min(count, starts[k] + counts[big[k]] - first)
            yield big[k], first - starts[k], part
            first, count = first + part, count - part

    size = max(1, -(-total // groups))
    rounded: dict[int, list[int]] = {}  # rounded length: next rank, end
    for first in range(0, total, size):
        top = next(lengths_of(first, 1))[0]
        if top in rounded:
            rounded[top][1] = min(first + size, total)
        else:
            rounded[top] = [first, min(first + size, total)]
    tops = list(rounded)
    if tops:
        for shape, amount in configurations(tops, [rounded[t][1] - rounded[t][0] for t in tops], most):
            used = [(t, int(a)) for t, a in zip(tops, shape) if a]
            times = min([int(amount + 1e-9), *[(rounded[t][1] - rounded[t][0]) // a for t, a in used]])
            if times < 1:
                continue
            first = out.fresh(times)
            filled: list[tuple[int, int, int]] = [(first, times, 0)]  # first sequence, how many, offset
            for t, a in used:
                for _ in range(a):
                    stretch = list(lengths_of(rounded[t][0], times))
                    rounded[t][0] += times
                    filled = _place(out, filled, stretch)
            for begin, count, offset in filled:
                out.add(begin, count, most - offset)
    rest: dict[int, list[tuple[int, int]]] = defaultdict(list)
    for t in tops:
        for n, rank, count in lengths_of(rounded[t][0], rounded[t][1] - rounded[t][0]):
            rest[n].append((rank, count))
    for n in lengths:
        for rank, count in rest[n] if n > most * large else [(0, counts[n])]:
            out.fit(n, rank, count)
    return out.runs


def _place(out: Plan, filled, stretch):
    """Put a stretch of pieces on a stretch of sequences, cutting both where either changes."""
    after, (k, skip) = [], (0, 0)
    for first, count, offset in filled:
        while count:
            length, rank, there = stretch[k]
            used = min(count, there - skip)
            out.runs.append((length, rank + skip, used, first, offset))
            after.append((first, used, offset + length))
            first, count, skip = first + used, count - used, skip + used
            if skip == there:
                k, skip = k + 1, 0
    return after


def packed(pieces: DataFrame, most: int = 1024, key: Column | None = None, length: str = "length",
           ties: tuple[str, ...] = ("doc_id", "piece")) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``."""
    spark = pieces.sparkSession
    keep = [c for c in pieces.columns if c not in ("sequence_id", "offset")]
    rank, one, slices, size, runs, at = unused(pieces.columns, "rank", "one", "slices", "size", "runs", "at")
    counts = {r[0]: r[1] for r in pieces.groupBy(length).count().collect()}
    if any(n is None or not 1 <= n <= most for n in counts):
        raise ValueError(f"a piece is not 1 to {most} tokens long")
    by_length = defaultdict(list)
    for n, first, _, sequence, offset in plan(counts, most):
        by_length[n].append((first, sequence, offset))
    table = spark.createDataFrame(
        [(n, -(-counts[n] // SLICE_ROWS), sorted(rows)) for n, rows in by_length.items()],
        f"`{size}` bigint, `{slices}` bigint, `{runs}` array<struct<first: bigint, sequence: bigint, offset: bigint>>")
    table = F.broadcast(table)  # a row per length and runs that depend on lengths and groups, not on the input
    key = F.xxhash64(*ties) if key is None else key
    ranked = running_before(pieces.withColumn(one, F.lit(1)), length, key, [F.col(t) for t in ties], one, rank,
                            table, size, slices)
    found = F.element_at(F.filter(F.col(runs), lambda r: r["first"] <= F.col(rank)), -1)
    return ranked.withColumn(at, found).select(
        *keep, (F.col(at)["sequence"] + F.col(rank) - F.col(at)["first"]).alias("sequence_id"),
        F.col(at)["offset"].alias("offset"))


def assembled(placed: DataFrame, pieces_with_ids: DataFrame) -> DataFrame:
    """The sequences themselves: ``sequence_id, ids, doc_ids``, a sequence being at most ``most`` tokens."""
    joined = placed.select("doc_id", "piece", "sequence_id", "offset").join(pieces_with_ids, ["doc_id", "piece"])
    parts = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "ids")))
    return joined.groupBy("sequence_id").agg(parts.alias("parts")).select(
        "sequence_id", F.flatten("parts.ids").alias("ids"), F.col("parts.doc_id").alias("doc_ids"))


def pack_documents(docs: DataFrame, most: int = 1024, end_id: int = 2, path: str | None = None,
                   doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Tokenise, cut and pack whole documents: one row per piece."""
    from seriesmill.llm.tokens import pieces
    return packed(settle(pieces(docs, doc_id, text, most, end_id, path), "pieces"), most)
