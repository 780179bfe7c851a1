"""First passage: how many bars until a price leaves a band, without an array of the bars ahead.

For every k a block has the highest high and the lowest low of the next 2^k bars (each level from the one before).
A row finds its first hit by descent: it steps over 2^k bars, largest steps first, while nothing in them hits.
Memory is rows x log2(bars ahead), time the same.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from seriesmill.plans.blocks import BLOCK, POS, Layout


@dataclass(frozen=True)
class Band:
    """Hit from above where a high reaches ``upper``, from below where a low reaches ``lower``, in the next ``ahead`` bars."""

    upper: Column
    lower: Column
    ahead: Column | int


def doubled(values: np.ndarray, levels: int, best, empty: float) -> list[np.ndarray]:
    """For each k the best of the 2^k values after every place."""
    out = [np.append(values[1:], empty)]
    for k in range(1, levels):
        half = 1 << (k - 1)
        shifted = np.full(len(values), empty)
        shifted[:max(len(values) - half, 0)] = out[-1][half:]
        out.append(best(out[-1], shifted))
    return out


def descend(high: np.ndarray, low: np.ndarray, upper: np.ndarray, lower: np.ndarray, ahead: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bars until the first hit (0 if there is none) and how many bars were looked at."""
    n = len(high)
    seen = np.clip(np.minimum(ahead, n - 1 - np.arange(n)), 0, None)
    levels = max(1, int(seen.max(initial=0)).bit_length())
    tops, bottoms = doubled(high, levels, np.fmax, -np.inf), doubled(low, levels, np.fmin, np.inf)
    at, here = np.zeros(n, dtype=np.int64), np.arange(n)
    for k in reversed(range(levels)):
        place = np.minimum(here + at, n - 1)
        clear = (at + (1 << k) <= seen) & ~(tops[k][place] >= upper) & ~(bottoms[k][place] <= lower)
        at = np.where(clear, at + (1 << k), at)
    return np.where(at < seen, at + 1, 0), seen


def with_passage(df: DataFrame, L: Layout, bands: Mapping[str, Band]) -> DataFrame:
    """Add ``<name>_at`` (bars until the first hit, 0 if none), ``_up`` and ``_down`` (which sides that bar hits),
    ``_seen`` (bars looked at) and ``_last`` (the close of the last of them) for every band.

    ``df`` is laid out in blocks whose copies reach ``ahead`` rows; a missing bound is never hit.
    """
    number = lambda x: (F.lit(x) if isinstance(x, int) else x).cast("long")
    asked = df.withColumns({f"_{n}_{k}": v for n, b in bands.items() for k, v in (
        ("upper", b.upper.cast("double")), ("lower", b.lower.cast("double")), ("ahead", number(b.ahead)))})
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    added = ", ".join(f"{n}_at bigint, {n}_up boolean, {n}_down boolean, {n}_seen bigint, {n}_last double" for n in bands)

    names, given = list(bands), df.columns  # what the tasks need to know

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by(POS)
        column = lambda c: table.column(c).to_numpy().astype(np.float64)
        high, low, close, here = column("high"), column("low"), column("close"), np.arange(table.num_rows)
        out = table.select(given)
        for n in names:
            upper, lower = column(f"_{n}_upper"), column(f"_{n}_lower")
            at, seen = descend(high, low, upper, lower, np.nan_to_num(column(f"_{n}_ahead")).astype(np.int64))
            hit = here + at
            for name, value in (("at", at), ("up", (at > 0) & (high[hit] >= upper)), ("down", (at > 0) & (low[hit] <= lower)),
                                ("seen", seen), ("last", close[here + seen])):
                out = out.append_column(f"{n}_{name}", pa.array(value))
        return out

    return asked.groupBy(*L.keys, BLOCK).applyInArrow(run, f"{fields}, {added}")
