"""Mix sources to target weights along a curriculum.

Each source has a weight that varies over training time (0 to 1, piecewise linear).  Its
integral is the source's weight in the mix; targets share a budget by these weights, none
above a cap.  A source's documents stand in a hash order; the tokens before a document,
over the target, are its share of the source's demand, and inverting the integrated
schedule at that share gives the training position.  Documents are range-sorted by position.

Defined results
    sources count in code point order, null last; a null or negative size counts as 0; each
    source is taken in whole passes, then in order while documents fit, then one later document
    if it brings the source nearer to its target; no document is taken more often than the cap
    (a whole number); a source without tokens is taken once, at position 0; an empty table
    gives an empty mix; rows equal in every order column are exchangeable.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from seriesmill.llm.common import bounded, numbered, running_before, settle, unused
from seriesmill.plans.prefix import totals_below

#: Documents per slice of a source's order.
SLICE_ROWS = 2_048


@dataclass(frozen=True)
class Schedule:
    """Weight over training time, linear between ``knots`` of (time, weight)."""

    knots: tuple[tuple[float, float], ...]

    def __post_init__(self):
        times = [t for t, _ in self.knots]
        if times[0] != 0.0 or times[-1] != 1.0 or times != sorted(times) or min(w for _, w in self.knots) < 0:
            raise ValueError("knots go from time 0 to 1 with weights of 0 or more")

    def integral(self) -> float:
        return sum(area for *_, area in self._parts())

    def _parts(self):
        for (t0, w0), (t1, w1) in zip(self.knots, self.knots[1:]):
            yield t0, t1, w0, w1, (t1 - t0) * (w0 + w1) / 2

    def time_at(self, share: Column) -> Column:
        """When the integrated weight reaches ``share`` (0 to 1) of its total."""
        want, before, pieces = share * F.lit(self.integral()), 0.0, []
        for t0, t1, w0, w1, area in self._parts():
            if area > 0:
                rest = F.greatest(want - F.lit(before), F.lit(0.0))
                slope = (w1 - w0) / (t1 - t0)
                root = F.sqrt(F.greatest(F.lit(w0 * w0) + F.lit(2 * slope) * rest, F.lit(0.0)))
                # the root of w0 x + slope x^2 / 2 = rest in the form without cancellation
                x = F.when(rest > 0, F.lit(2.0) * rest / (F.lit(w0) + root)).otherwise(F.lit(0.0))
                before += area
                pieces.append((before, F.least(F.lit(t0) + x, F.lit(t1))))
        out = pieces[-1][1]
        for upto, value in reversed(pieces[:-1]):
            out = F.when(want <= F.lit(upto), value).otherwise(out)
        return out


def source_targets(sizes: DataFrame, schedules: Sequence[Schedule], share: float, cap: int) -> DataFrame:
    """Per row of ``source, source_size, docs``: its schedule number and target.

    A target is weight x level, at most cap x size; the level at which all targets add up to the
    budget is found on running totals over the sources sorted by (cap x size) / weight.
    """
    order = [F.col("source").isNull(), F.col("source")]
    rows, _ = numbered(sizes, order, "rank")
    which = F.pmod(F.col("rank"), F.lit(len(schedules))).cast("int")
    weights = F.array(*[F.lit(s.integral()) for s in schedules])
    rows = settle(rows.select("source", "source_size", "docs", which.alias("schedule"),
                              F.get(weights, which).alias("weight"))
                  .withColumn("most", F.lit(float(cap)) * F.col("source_size"))
                  .withColumn("full_at", F.when(F.col("weight") > 0, F.col("most") / F.col("weight"))), "sources")
    total = rows.agg(F.sum("most"), F.sum("weight"), F.sum("source_size")).first()
    budget = share * float(total[2] or 0)
    below = totals_below(rows.where("full_at is not null"), "full_at", {"m": F.col("most"), "w": F.col("weight")})
    # with every source that is full below this level left at its cap, the others reach:
    level = (F.lit(budget) - F.col("m_below")) / (F.lit(float(total[1] or 0)) - F.col("w_below"))
    found = below.select("full_at", level.alias("level")).where(F.col("level") <= F.col("full_at")).agg(
        F.min_by("level", "full_at")).first()[0]
    target = F.col("most") if found is None else F.least(F.col("most"), F.col("weight") * F.lit(float(found)))
    return settle(rows.select("source", "source_size", "docs", "schedule", F.coalesce(
        F.when(F.col("weight") > 0, target), F.lit(0.0)).alias("target")), "targets")


def planned(docs: DataFrame, key: Column, ties: Sequence[Column], schedules: Sequence[Schedule], share: float,
            cap: int, source: str = "source", size: str = "size") -> DataFrame:
    """Narrow ``docs`` (ids and sizes, without texts) with ``source_size``, ``target``, ``copies`` and ``positions`` (one per copy, ascending)."""
    group, amount, want, slices, before, whole, kind, near, gap, pick = unused(
        docs.columns, "mix_source", "amount", "mix_target", "slices", "before", "mix_size", "mix_schedule",
        "near", "gap", "pick")
    sized = docs.withColumn(amount, F.greatest(F.coalesce(F.col(size), F.lit(0)), F.lit(0)).cast("long"))
    sources = source_targets(sized.groupBy(F.col(source).alias("source")).agg(
        F.sum(amount).alias("source_size"), F.count(F.lit(1)).alias("docs")), schedules, share, cap)
    table = bounded(sources.select(
        F.col("source").alias(group), F.col("source_size").alias(whole),
        F.col("schedule").alias(kind), F.col("target").alias(want),
        F.ceil(F.col("docs") / F.lit(SLICE_ROWS)).alias(slices)), 120)
    total, at = F.col(whole).cast("double"), F.col(before) + F.col(amount) / 2
    run = settle(running_before(sized, source, key, ties, amount, before, table, group, slices), "mix-run")
    full = F.when(total > 0, F.least(F.lit(float(cap)), F.floor(F.col(want) / total))).otherwise(F.lit(0.0))
    rest, end = F.col(want) - full * total, F.col(before) + F.col(amount)
    # the last pass takes documents in order while they fit, then the later one that fits the gap best
    gaps = run.groupBy(group).agg((F.first(rest) - F.coalesce(F.max(F.when(end <= rest, end)), F.lit(0))).alias(gap))
    gaps = bounded(settle(gaps.withColumnRenamed(group, near), "mix-gaps"), 80)
    off = F.abs(F.col(amount) - F.col(gap))
    late = run.where((end > rest) & (F.col(amount) > 0)).join(gaps, F.col(group).eqNullSafe(F.col(near)))
    picks = late.where(off < F.col(gap)).groupBy(near).agg(F.min_by(before, F.struct(off, before)).alias(pick))
    picks = bounded(settle(picks, "mix-picks"), 80)
    run = run.join(picks, F.col(group).eqNullSafe(F.col(near)), "left")
    extra = (end <= rest) | ((F.col(before) == F.col(pick)) & (F.col(amount) > 0))
    copies = F.least(F.lit(cap), (full + F.coalesce(extra, F.lit(False)).cast("int")).cast("int"))
    share_at = lambda e: F.when(total > 0, F.least((e * total + at) / F.col(want), F.lit(1.0))).otherwise(F.lit(0.0))

    def when_due(e: Column) -> Column:
        out = schedules[-1].time_at(share_at(e))
        for k in range(len(schedules) - 1):
            out = F.when(F.col(kind) == k, schedules[k].time_at(share_at(e))).otherwise(out)
        return out

    return (run.withColumn("copies", F.when(total > 0, copies).otherwise(F.lit(1)))
            .withColumn("positions", F.when(F.col("copies") > 0, F.transform(
                F.sequence(F.lit(0), F.col("copies") - 1), when_due)).otherwise(F.array().cast("array<double>")))
            .select(*docs.columns, F.col(whole).alias("source_size"), F.col(want).alias("target"),
                    "copies", "positions"))


def in_training_order(plan: DataFrame, ties: Sequence[str]) -> DataFrame:
    """One row per taken copy with its ``position``, range-sorted by position."""
    rows = plan.select(*[c for c in plan.columns if c not in ("copies", "positions", "position")],
                       F.explode("positions").alias("position"))
    return rows.repartitionByRange("position", *ties).sortWithinPartitions("position", *ties)
