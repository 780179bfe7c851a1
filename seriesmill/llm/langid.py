"""Language identification by rank-order profiles.

Words are padded with blanks and cut into n-grams of one to three characters.  A profile is
the list of the most frequent n-grams of a language, by rank.  A document goes to the
language whose profile is nearest: the sum, over the document's own most frequent n-grams,
of how far each is out of place, an n-gram the profile lacks counting as a full profile.

Defined results
    text without letters, or null: `und`, score 0; equal counts rank by code points, equal
    distances go to the first language by name; null languages and null texts teach nothing;
    without any taught language everything is `und`; whole texts are counted, however long;
    further columns are passed over; an empty table gives none.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

UNKNOWN = "und"
ORDERS, PROFILE = (1, 2, 3), 300
BLANK = np.uint64(0x110000)  # no character has this code
#: Characters that are counted in one go, and distinct n-grams a task holds before it hands them on.
CHARS, HELD = 1 << 20, 1 << 20


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Whether a code point is a letter."""
    return np.array([chr(c).isalpha() for c in range(0x110000)])


def _codes(text: str) -> np.ndarray:
    """Lower-case code points; all but letters become one blank (0) between words and at both ends."""
    raw = np.frombuffer(text.lower().encode("utf-32-le", "replace"), dtype="<u4")
    letter = _letters()[raw]
    if not letter.any():
        return np.zeros(0, dtype=np.uint64)
    padded = np.zeros(len(raw) + 2, dtype=np.uint64)
    padded[1:-1] = np.where(letter, raw, 0)
    keep = np.ones(len(padded), dtype=bool)
    keep[1:] = (padded[1:] != 0) | (padded[:-1] != 0)
    return padded[keep]


def grams(codes: np.ndarray) -> np.ndarray:
    """All n-grams of a coded text as numbers: 21 bits per character, blanks only at the ends.

    A blank in front is marked by a code of its own, so grams of different lengths never meet.
    """
    out = []
    blank = codes == 0
    codes = np.where(blank, BLANK, codes)
    for n in ORDERS:
        if len(codes) < n:
            break
        packed = codes[:len(codes) - n + 1].copy()
        for j in range(1, n):
            packed = (packed << np.uint64(21)) | codes[j:len(codes) - n + 1 + j]
        if n == 1:
            whole = ~blank
        elif n == 2:
            whole = ~(blank[:-1] & blank[1:])
        else:
            whole = ~blank[1:-1]
        out.append(packed[whole])
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def counted(numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct numbers, ascending, with their counts."""
    if not len(numbers):
        return numbers, np.zeros(0, np.int64)
    ordered = np.sort(numbers)
    first = np.nonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))[0]
    return ordered[first], np.diff(np.append(first, len(ordered)))


def counts_of(text: str) -> tuple[np.ndarray, np.ndarray]:
    """N-grams of a whole text and their counts; a very long text is counted in parts cut at blanks."""
    codes = _codes(text)
    if len(codes) <= CHARS:
        return counted(grams(codes))
    blanks = np.nonzero(codes == 0)[0]
    totals, begin = (np.zeros(0, np.uint64), np.zeros(0, np.int64)), 0
    while begin < len(codes) - 1:
        later = blanks[np.searchsorted(blanks, begin, side="right"):]
        at = int(later[min(np.searchsorted(later, begin + CHARS), len(later) - 1)])
        totals = merged(totals, counted(grams(codes[begin:at + 1])))
        begin = at
    return totals


def merged(a, b):
    numbers = np.concatenate([a[0], b[0]])
    order = np.argsort(numbers, kind="stable")
    numbers, values = numbers[order], np.concatenate([a[1], b[1]])[order]
    if not len(numbers):
        return numbers, values
    first = np.nonzero(np.concatenate([[True], numbers[1:] != numbers[:-1]]))[0]
    return numbers[first], np.add.reduceat(values, first)


def ranked(numbers: np.ndarray, counts: np.ndarray, most: int = PROFILE) -> np.ndarray:
    """The most frequent n-grams, best first."""
    if len(counts) > 4 * most:  # those that can still be among the best, ties included
        line = np.partition(counts, len(counts) - most)[len(counts) - most]
        able = counts >= line
        numbers, counts = numbers[able], counts[able]
    return numbers[np.lexsort((numbers, -counts))[:most]]


def learn(docs: DataFrame, text: str = "text", lang: str = "lang", most: int = PROFILE) -> dict[str, np.ndarray]:
    """Profiles per language from all rows; ``most`` n-grams per language reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, tuple] = {}

        def out():
            for name, (numbers, counts) in held.items():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(numbers), pa.string()), pa.array(numbers.view(np.int64)), pa.array(counts.astype(np.int64))],
                    ["lang", "gram", "n"])
            held.clear()

        for batch in batches:
            texts: dict[str, list] = {}
            for value, name in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                texts.setdefault(name, []).append(value)
            for name, values in texts.items():
                parts, size = [], 0
                for value in [*values, None]:
                    if parts and (value is None or size + len(value) > CHARS):
                        # blanks at both ends keep words of different texts apart
                        found = counts_of(" ".join(parts))
                        held[name] = merged(held[name], found) if name in held else found
                        parts, size = [], 0
                    if value is not None:
                        parts.append(value)
                        size += len(value)
            if sum(len(h[0]) for h in held.values()) > HELD:
                yield from out()
        yield from out()

    taught = docs.where(F.col(text).isNotNull() & F.col(lang).isNotNull()).select(
        F.col(text).cast("string").alias("text"), F.col(lang).cast("string").alias("lang"))
    sums = taught.mapInArrow(run, "lang string, gram bigint, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    # a limit per group is applied before the shuffle too, so a common language is no large group
    best = Window.partitionBy("lang").orderBy(F.col("n").desc(), F.col("gram"))
    rows = sums.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= most).select("lang", "gram", "rank").collect()
    profiles: dict[str, list] = {}
    for name, gram, rank in sorted(rows):
        profiles.setdefault(name, []).append((rank, gram))
    return {name: np.array([g for _, g in sorted(p)], dtype=np.int64).view(np.uint64) for name, p in profiles.items()}


class Judge:
    """Out-of-place distances to a set of profiles."""

    def __init__(self, profiles: dict[str, np.ndarray], most: int = PROFILE):
        self.names, self.most = sorted(profiles), most
        self.known = np.unique(np.concatenate([*profiles.values(), np.zeros(0, np.uint64)]))
        self.ranks = np.full((len(self.known) + 1, max(len(self.names), 1)), -1, dtype=np.int64)
        for k, name in enumerate(self.names):
            self.ranks[np.searchsorted(self.known, profiles[name]), k] = np.arange(len(profiles[name]))

    def distances(self, text: str | None) -> np.ndarray | None:
        numbers, counts = counts_of(text or "")
        if not len(numbers) or not self.names:
            return None
        mine = ranked(numbers, counts, self.most)
        at = np.minimum(np.searchsorted(self.known, mine), len(self.known) - 1)
        at = np.where(self.known[at] == mine, at, len(self.known))
        ranks = self.ranks[at]
        away = np.where(ranks < 0, self.most, np.abs(ranks - np.arange(len(mine))[:, None]))
        return away.sum(axis=0) / (len(mine) * self.most)

    def judge(self, text: str | None) -> tuple[str, float]:
        """Language and score: one minus the distance as a share of the largest possible."""
        away = self.distances(text)
        if away is None:
            return UNKNOWN, 0.0
        best = int(np.argmin(away))
        return self.names[best], float(min(1.0, max(0.0, 1.0 - away[best])))


def identify(docs: DataFrame, profiles: dict[str, np.ndarray], keep: list[str], text: str = "text") -> DataFrame:
    """``keep`` columns with ``lang_pred`` and ``score``; the profiles (300 numbers a language) are broadcast."""
    shared = docs.sparkSession.sparkContext.broadcast(profiles)
    source = docs.select(*keep, F.col(text).cast("string").alias("_judged_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = Judge(shared.value)
        for batch in batches:
            names, scores = [], []
            for value in batch.column(batch.num_columns - 1).to_pylist():
                name, score = judge.judge(value)
                names.append(name)
                scores.append(score)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                [*batch.schema.names[:-1], "lang_pred", "score"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields[:-1])
    return source.mapInArrow(run, f"{kinds}, lang_pred string, score double")
