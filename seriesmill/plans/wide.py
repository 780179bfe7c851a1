"""Exact quantiles and bin counts of many columns at once, without unpivoting the rows.

Quantiles are found by radix selection.  A double's bits, reordered so that they compare like the value, are cut
into three digits.  Each pass counts the leading bits of all columns inside the tasks (one row per series,
column and digit that occurs leaves a task, however many rows it read) and keeps, for every wanted rank, the digit
that holds it and the rank inside; the next pass looks at the values under kept digits only.  The third pass ends
with the values themselves.

What tasks must know (kept digits, bin edges) has a known size for a series, so series are taken in packs whose
tables stay below ``PACK_BYTES``; a table stored by series is read one pack at a time.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from seriesmill.plans.materialize import settle

#: Leading bits that the passes look at.
BITS = (18, 41, 64)
#: Most bytes that travel to every task.
PACK_BYTES = 8_000_000


def ordered_bits(values: np.ndarray) -> np.ndarray:
    """64-bit numbers that compare like the doubles they stand for (both zeros are one)."""
    bits = (np.ascontiguousarray(values, dtype=np.float64) + 0.0).view(np.int64)
    return bits ^ (bits >> 63 & np.int64(0x7FFFFFFFFFFFFFFF))


@dataclass
class Pack:
    """Rows of some series: ``_g`` numbers them, ``names`` has their keys."""

    rows: DataFrame
    names: DataFrame
    count: int


def packs(df: DataFrame, groups: Sequence[str], row_bytes: int) -> Iterator[Pack]:
    """The rows in packs of series of about ``row_bytes`` each; ``groups`` may be empty (one series)."""
    groups, spark = list(groups), df.sparkSession
    if not groups:
        yield Pack(df.withColumn("_g", F.lit(0)), spark.createDataFrame([(0,)], "_g int"), 1)
        return
    keys = settle(df.select(*groups).distinct())
    per = max(1, PACK_BYTES // row_bytes)
    order = Window.orderBy(*groups)  # one row per series
    numbered = settle(keys.withColumn("_g", F.row_number().over(order) - 1))
    for begin in range(0, keys.count(), per):
        names = numbered.where((F.col("_g") >= begin) & (F.col("_g") < begin + per)).withColumn("_g", F.col("_g") - begin)
        own = names.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(groups)], "_g")
        same = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(groups)]
        joined = df.join(F.broadcast(own), same).drop(*[f"_k{i}" for i in range(len(groups))])  # at most ``per`` rows
        yield Pack(joined, names, per)


def _matrix(batch: pa.RecordBatch, first: int, n: int) -> np.ndarray:
    return np.stack([batch.column(first + c).to_numpy(zero_copy_only=False).astype(np.float64, copy=False) for c in range(n)]) if n else np.zeros((0, batch.num_rows))


def _pairs(group: np.ndarray, digit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (group, digit) and their counts."""
    order = np.lexsort((digit, group))
    group, digit = group[order], digit[order]
    new = np.flatnonzero(np.concatenate([[True], (group[1:] != group[:-1]) | (digit[1:] != digit[:-1])])) if len(group) else np.zeros(0, dtype=np.int64)
    return group[new], digit[new], np.diff(np.concatenate([new, [len(group)]]))


def _digit_counts(columns: int, bits: int, kept: Mapping[tuple[int, int], np.ndarray] | None, before: int) -> Callable:
    """Counts ``_g, c, digit, n`` of the leading ``bits``; ``kept`` digits (of ``before`` bits) say which values count."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            series, out = batch.column(0).to_numpy(), []
            for c, x in enumerate(_matrix(batch, 1, columns)):
                there = ~np.isnan(x)
                g, key = series[there], ordered_bits(x[there])
                if kept is not None:
                    chosen = np.zeros(len(g), dtype=bool)
                    for k in np.unique(g).tolist():
                        if (k, c) in kept:
                            own = g == k
                            chosen[own] = np.isin(key[own] >> np.int64(64 - before), kept[k, c])
                    g, key = g[chosen], key[chosen]
                g, digit, n = _pairs(g, key >> np.int64(64 - bits) if bits < 64 else key)
                out.append((g, np.full(len(g), c), digit, n))
            g, c, digit, n = (np.concatenate(v) for v in zip(*out))
            yield pa.RecordBatch.from_arrays([pa.array(g.astype(np.int32)), pa.array(c.astype(np.int32)), pa.array(digit.astype(np.int64)), pa.array(n.astype(np.int64))],
                                             ["_g", "c", "digit", "n"])
    return run


def histograms(df: DataFrame, groups: Sequence[str], columns: Sequence[str], bits: int = BITS[0]) -> DataFrame:
    """``groups..., feature, digit, n``: how many values of every column share their leading ``bits``.

    Histograms of parts of the rows add up to the histogram of all rows.
    """
    groups, columns = list(groups), list(columns)
    parts = []
    for pack in packs(df, groups, 64 * max(1, len(columns))):
        rows = pack.rows.select("_g", *[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(columns)])
        counts = rows.mapInArrow(_digit_counts(len(columns), bits, None, 0), "_g int, c int, digit bigint, n bigint").groupBy("_g", "c", "digit").agg(F.sum("n").alias("n"))
        parts.append(counts.join(F.broadcast(pack.names), "_g").select(*groups, F.array(*[F.lit(c) for c in columns])[F.col("c")].alias("feature"), "digit", "n"))
    if not parts:
        return df.select(*groups, F.lit("").alias("feature"), F.lit(0).cast("bigint").alias("digit"), F.lit(0).cast("bigint").alias("n")).limit(0)
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _value(bits: np.ndarray) -> np.ndarray:
    return (bits ^ (bits >> 63 & np.int64(0x7FFFFFFFFFFFFFFF))).view(np.float64)


def quantiles(df: DataFrame, groups: Sequence[str], columns: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """``groups..., feature, p, q``: linearly interpolated quantiles of the non-missing values of every column.

    NULL and NaN are missing; a column without values in a series has no row.
    """
    groups, columns, probs = list(groups), list(columns), [float(p) for p in probs]
    parts = [_pack_quantiles(pack, columns, probs).join(F.broadcast(pack.names), "_g").select(*groups, "feature", "p", "q")
             for pack in packs(df, groups, 64 * max(1, len(columns)) * max(1, len(probs)))]
    out = parts[0] if parts else df.sparkSession.createDataFrame([], "feature string, p double, q double").join(df.select(*groups).limit(0)).select(*groups, "feature", "p", "q")
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _pack_quantiles(pack: Pack, columns: Sequence[str], probs: Sequence[float]) -> DataFrame:
    rows = pack.rows.select("_g", *[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(columns)])
    kept, before, wanted = None, 0, None
    for bits in BITS:
        counts = rows.mapInArrow(_digit_counts(len(columns), bits, kept, before), "_g int, c int, digit bigint, n bigint").groupBy(
            "_g", "c", "digit").agg(F.sum("n").alias("n"))
        if wanted is None:
            at = Window.partitionBy("_g", "c").orderBy("digit").rowsBetween(Window.unboundedPreceding, 0)
            whole = Window.partitionBy("_g", "c")
            placed = counts.withColumns({"upto": F.sum("n").over(at), "total": F.sum("n").over(whole)})
            # the ranks below and above each wanted place
            ranks = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(up).alias("up"),
                                       (F.ceil if up else F.floor)(F.lit(p) * (F.col("total") - 1)).cast("bigint").alias("rank"))
                              for i, p in enumerate(probs) for up in (False, True)])
            held = F.filter(ranks, lambda r: (r["rank"] < F.col("upto")) & (r["rank"] >= F.col("upto") - F.col("n")))
            wanted = placed.select("_g", "c", "digit", "total", (F.col("upto") - F.col("n")).alias("_below"), F.explode(held).alias("r")).select(
                "_g", "c", "r.i", "r.up", "total", "digit", (F.col("r.rank") - F.col("_below")).alias("rank"))
        else:
            parent = F.shiftright("digit", bits - before)
            at = Window.partitionBy("_g", "c", "parent").orderBy("digit").rowsBetween(Window.unboundedPreceding, 0)
            placed = counts.withColumn("parent", parent).withColumn("upto", F.sum("n").over(at))
            wanted = placed.join(wanted.select(F.col("_g").alias("_wg"), F.col("c").alias("_wc"), F.col("digit").alias("_wd"), "i", "up", "total", "rank"),
                                 (F.col("_g") == F.col("_wg")) & (F.col("c") == F.col("_wc")) & (F.col("parent") == F.col("_wd"))
                                 & (F.col("rank") < F.col("upto")) & (F.col("rank") >= F.col("upto") - F.col("n"))).select(
                "_g", "c", "i", "up", "total", "digit", (F.col("rank") - F.col("upto") + F.col("n")).alias("rank"))
        wanted = settle(wanted)
        if bits < 64:  # two digits per series, column and probability at most: the size of a pack
            kept, before = {}, bits
            for r in wanted.groupBy("_g", "c").agg(F.collect_set("digit").alias("digits")).collect():
                kept[r["_g"], r["c"]] = np.array(sorted(r["digits"]), dtype=np.int64)

    def values(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(_value(batch.column(5).to_numpy()))], ["_g", "c", "i", "up", "total", "v"])

    found = wanted.select("_g", "c", "i", "up", "total", "digit").mapInArrow(values, "_g int, c int, i int, up boolean, total bigint, v double")
    both = found.groupBy("_g", "c", "i", "total").agg(F.max(F.when(~F.col("up"), F.col("v"))).alias("a"), F.max(F.when(F.col("up"), F.col("v"))).alias("b"))
    place = F.array(*[F.lit(p) for p in probs])[F.col("i")] * (F.col("total") - 1)
    return both.select("_g", F.array(*[F.lit(c) for c in columns])[F.col("c")].alias("feature"), F.array(*[F.lit(p) for p in probs])[F.col("i")].alias("p"),
                       (F.col("a") + (F.col("b") - F.col("a")) * (place - F.floor(place))).alias("q"))


def bin_counts(df: DataFrame, groups: Sequence[str], columns: Sequence[str], edges: DataFrame, marks: Mapping[str, str]) -> DataFrame:
    """``groups..., feature, bin, <marks>``: values per bin, counted where each mark's condition holds.

    ``edges`` has ``groups..., feature, edges`` (ascending; at most a few per column); the bin is the number of edges
    that are not above the value.  Columns a series has no edges for, and values that are not finite, are left out.
    """
    groups, columns, names = list(groups), list(columns), list(marks)
    width = edges.agg(F.max(F.size("edges"))).first()[0] or 1
    parts = []
    for pack in packs(df, groups, 8 * max(1, len(columns)) * width):
        same = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in groups]
        own = edges.join(F.broadcast(pack.names.withColumnsRenamed({k: f"_k_{k}" for k in groups})), same) if groups else edges.withColumn("_g", F.lit(0))
        at = {(r["_g"], r["feature"]): np.array(r["edges"], dtype=float) for r in own.select("_g", "feature", "edges").collect()}  # the size of a pack
        known = {(g, columns.index(f)): e for (g, f), e in at.items() if f in columns}

        def run(batches: Iterator[pa.RecordBatch], known=known) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                series = batch.column(0).to_numpy()
                marked = [batch.column(1 + k).to_numpy(zero_copy_only=False).astype(bool) for k in range(len(names))]
                out = []
                for c, x in enumerate(_matrix(batch, 1 + len(names), len(columns))):
                    good = np.isfinite(x)
                    for g in np.unique(series[good]).tolist():
                        if (g, c) in known:
                            own = good & (series == g)
                            bins = np.searchsorted(known[g, c], x[own], side="right")
                            size = len(known[g, c]) + 1
                            counts = [np.bincount(bins[m[own]], minlength=size) for m in marked]
                            out.append((np.full(size, g), np.full(size, c), np.arange(size), *counts))
                if out:
                    g, c, b, *counts = (np.concatenate(v) for v in zip(*out))
                    yield pa.RecordBatch.from_arrays([pa.array(v.astype(np.int32)) for v in (g, c, b)] + [pa.array(v.astype(np.int64)) for v in counts],
                                                     ["_g", "c", "bin", *names])

        rows = pack.rows.select("_g", *[F.coalesce(F.expr(marks[n]), F.lit(False)).alias(n) for n in names],
                                *[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(columns)])
        counted = rows.mapInArrow(run, "_g int, c int, bin int, " + ", ".join(f"{n} bigint" for n in names)).groupBy("_g", "c", "bin").agg(
            *[F.sum(n).alias(n) for n in names])
        parts.append(counted.join(F.broadcast(pack.names), "_g").select(*groups, F.array(*[F.lit(c) for c in columns])[F.col("c")].alias("feature"), "bin", *names))
    if not parts:
        return edges.select(*groups, "feature", F.lit(0).alias("bin"), *[F.lit(0).cast("bigint").alias(n) for n in names]).limit(0)
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
