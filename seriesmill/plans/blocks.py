"""Row blocks: windows over a long series without one task per series.

A series may hold a third of all rows, so no operator here sorts a whole series in
one task.  Every row gets its position in the series from counts per time bucket,
series are cut into blocks of equal row count, and the rows a block needs from its
neighbours (look-back, look-ahead) are copied into it.  Windows then partition by
(series, block): each group holds at most ``rows + before + after`` rows.

Two kinds of computation follow from that layout:

* bounded frames (rolling, lag, horizon, and smoothing averages, whose weights vanish
  below double precision after ``ema_reach`` rows) need only the copied rows;
* unbounded frames (running sum/max/last) combine a block-local window with a carry
  from a table of one row per block.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from seriesmill.keys import SERIES_KEYS
from seriesmill.functions.scalar import col

POS, TOTAL, BLOCK, SUB, OWN = "_pos", "_total", "_block", "_sub", "_own"
HELPERS = (POS, TOTAL, BLOCK, SUB, OWN)
_LN_EPS = 41.5  # exp(-41.5) is below 1e-18


@dataclass(frozen=True)
class Layout:
    """How a set of series is cut into blocks.

    ``bucket_ms`` is the width of the time buckets used for counting positions (a task numbers one); with
    one bar per step a bucket of ``bucket_steps`` steps holds at most as many bars.
    """

    step_ms: int
    keys: tuple[str, ...] = SERIES_KEYS
    ts: str = "ts"
    ties: tuple[str, ...] = ()
    rows: int = 65_536
    before: int = 0
    after: int = 0
    sub_rows: int = 2_048
    bucket_steps: int = 8_192

    def reach(self, before: int = 0, after: int = 0) -> "Layout":
        return replace(self, before=max(before, self.before), after=max(after, self.after))

    def cut(self, rows: int) -> "Layout":
        """The layout with blocks of ``rows`` rows at most: more tasks where few rows are copied."""
        return replace(self, rows=min(rows, self.rows), bucket_steps=min(rows, self.bucket_steps))

    @property
    def bucket_ms(self) -> int:
        return self.step_ms * self.bucket_steps

    def window(self) -> WindowSpec:
        """Rows of a block in time order (one sort serves every frame below)."""
        return Window.partitionBy(*self.keys, BLOCK).orderBy(SUB, POS)

    def frame(self, start: int, end: int = 0) -> WindowSpec:
        return self.window().rowsBetween(start, end)


def with_positions(df: DataFrame, keys: Sequence[str], bucket: Column,
                   order: Sequence[Column | str]) -> DataFrame:
    """0-based position per key in (bucket, order) order, and the row count per key.

    Only the table of counts (one row per bucket) is ordered per key; rows themselves
    are sorted inside their bucket.
    """
    keyed = df.withColumn("_bucket", bucket)
    at = [*keys, "_bucket"]
    per_key = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
    counts = keyed.groupBy(*at).agg(F.count(F.lit(1)).alias("_rows_in_bucket"))
    offsets = counts.select(
        *at,
        F.coalesce(
            F.sum("_rows_in_bucket").over(
                per_key.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)),
            F.lit(0)).alias("_offset"),
        F.sum("_rows_in_bucket").over(per_key).alias(TOTAL),
    )
    local = Window.partitionBy(*at).orderBy(*order)
    numbered = keyed.withColumn("_local", F.row_number().over(local))
    return (numbered.join(offsets, at)
            .withColumn(POS, F.col("_offset") + F.col("_local") - 1)
            .drop("_bucket", "_local", "_offset"))


def to_blocks(df: DataFrame, layout: Layout) -> DataFrame:
    """Number the rows of every series and lay them out in blocks with copied edges."""
    bucket = F.floor(F.unix_millis(F.col(layout.ts)) / F.lit(layout.bucket_ms))
    return lay_out(with_positions(df, layout.keys, bucket, [layout.ts, *layout.ties]), layout)


def lay_out(numbered: DataFrame, layout: Layout) -> DataFrame:
    """Rows with their positions in blocks with copied edges."""
    block_of = lambda pos: F.floor(pos / F.lit(layout.rows))
    home = block_of(F.col(POS))
    if layout.before == 0 and layout.after == 0:
        placed = numbered.withColumn(BLOCK, home)
    else:
        first = block_of(F.greatest(F.col(POS) - F.lit(layout.after), F.lit(0)))
        last = block_of(F.least(F.col(POS) + F.lit(layout.before), F.col(TOTAL) - 1))
        placed = numbered.withColumn(BLOCK, F.explode(F.sequence(first, last)))
    # stated once, so that windows by (block) and by (block, stretch) share one exchange
    return placed.repartition(*layout.keys, BLOCK).withColumns({
        OWN: F.col(BLOCK) == home,
        SUB: F.floor(F.col(POS) / F.lit(layout.sub_rows)),
    })


def from_blocks(df: DataFrame, keep_position: bool = False) -> DataFrame:
    """Keep each row once (in its home block) and drop the helper columns."""
    drop = [c for c in HELPERS if not (keep_position and c in (POS, TOTAL))]
    return df.where(F.col(OWN)).drop(*drop)


# --- bounded frames -----------------------------------------------------------------

@dataclass(frozen=True)
class Rolling:
    """Rolling statistics that are NULL until ``size`` values are present."""

    layout: Layout
    size: int
    shift: int = 0

    def _over(self, aggregate, x: Column) -> Column:
        frame = self.layout.frame(-(self.size - 1) - self.shift, -self.shift)
        return F.when(F.count(x).over(frame) >= self.size, aggregate(x).over(frame))

    def mean(self, x): return self._over(F.avg, col(x))
    def sum(self, x): return self._over(F.sum, col(x))
    def std(self, x): return self._over(F.stddev_pop, col(x))
    def max(self, x): return self._over(F.max, col(x))
    def min(self, x): return self._over(F.min, col(x))

    def zscore(self, x) -> Column:
        frame, x = self.layout.frame(-(self.size - 1) - self.shift, -self.shift), col(x)
        score = F.try_divide(x - F.avg(x).over(frame), F.stddev_pop(x).over(frame))
        return F.when(F.count(x).over(frame) >= self.size, score)


def lag(layout: Layout, x: Column | str, k: int = 1) -> Column:
    return F.lag(col(x), k).over(layout.window())


def pct_change(layout: Layout, x: Column | str, k: int = 1) -> Column:
    return F.try_divide(col(x), lag(layout, x, k)) - 1


def with_long_rolling(df: DataFrame, layout: Layout,
                      specs: Mapping[str, tuple[str, str, int]]) -> DataFrame:
    """Rolling max/min/mean over long windows in O(rows), for ``name: (kind, column, size)``.

    Windows of ``size`` rows span at most two stretches of ``size`` rows: the tail of
    one (running from its end) and the head of the next (running from its start).
    """
    combine = {"max": F.max, "min": F.min, "mean": F.sum}
    sizes = sorted({size for _, _, size in specs.values()})
    df = df.withColumns({f"_stretch_{n}": F.floor(F.col(POS) / F.lit(n)) for n in sizes})

    def run(end: str, order: Column) -> dict[str, Column]:
        frames = {n: Window.partitionBy(*layout.keys, BLOCK, f"_stretch_{n}").orderBy(order)
                  .rowsBetween(Window.unboundedPreceding, 0) for n in sizes}
        return {f"_{end}_{name}": combine[kind](column).over(frames[n]) for name, (kind, column, n) in specs.items()}

    df = df.withColumns(run("head", F.col(POS))).withColumns(run("tail", F.col(POS).desc()))
    out = {}
    for name, (kind, _, size) in specs.items():
        head, tail = F.col(f"_head_{name}"), lag(layout, f"_tail_{name}", size - 1)
        if kind == "mean":
            closes = F.col(POS) % size == size - 1
            merged = F.when(closes, head).otherwise(head + tail) / F.lit(size)
        else:
            merged = (F.greatest if kind == "max" else F.least)(head, tail)
        out[name] = F.when(F.col(POS) >= size - 1, merged)
    helpers = [f"_stretch_{n}" for n in sizes] + [f"_{e}_{n}" for n in specs for e in ("head", "tail")]
    return df.withColumns(out).drop(*helpers)


# --- smoothing averages -------------------------------------------------------------

@dataclass(frozen=True)
class Smooth:
    """Exponential average of a column with no gaps after position ``start``.

    ``gain`` is the weight of the newest value (2/(span+1), or 1/n for Wilder).
    """

    x: str
    gain: float
    min_periods: int
    start: int = 0


def span(n: int) -> float:
    return 2.0 / (n + 1)


def ema_reach(gain: float) -> int:
    """Rows after which an old value weighs less than double precision can hold."""
    return math.ceil(_LN_EPS / -math.log1p(-gain))


def with_smooth(df: DataFrame, layout: Layout, specs: Mapping[str, Smooth]) -> DataFrame:
    """Add exponential averages as windowed weighted sums.

    Inside a stretch of ``sub_rows`` rows the average is a running sum of values scaled
    by q^-j, rescaled by q^j; earlier stretches enter through their end values.  All
    windows share one sort order, so any number of averages costs one sort.
    """
    size = layout.sub_rows
    j = F.col(POS) % F.lit(size)
    inner = (Window.partitionBy(*layout.keys, BLOCK, SUB).orderBy(POS)
             .rowsBetween(Window.unboundedPreceding, 0))
    stretches = Window.partitionBy(*layout.keys, BLOCK).orderBy(SUB)
    local, carries, result = {}, {}, {}
    for name, s in specs.items():
        q = 1.0 - s.gain
        if -math.log(q) * size > 650:
            raise ValueError(f"sub_rows={size} overflows for gain {s.gain}; use a smaller sub_rows")
        if ema_reach(s.gain) > layout.before and layout.rows < 10 ** 15:
            raise ValueError(f"look-back {layout.before} is shorter than the reach of {name}")
        x = F.col(s.x)
        weighted = (F.when(F.col(POS) == s.start, x)
                    .when(F.col(POS) > s.start, x * F.lit(s.gain)).otherwise(F.lit(0.0)))
        up = F.pow(F.lit(q), -j.cast("double"))
        down = F.pow(F.lit(q), j.cast("double"))
        local[f"_l_{name}"] = F.sum(weighted * up).over(inner) * down
        carry = F.lit(0.0)
        depth = max(1, math.ceil(_LN_EPS / (-math.log(q) * size)))
        at_end = F.when(j == size - 1, F.col(f"_l_{name}"))
        for m in range(1, depth + 1):
            end = F.max(at_end).over(stretches.rangeBetween(-m, -m))
            carry = carry + F.coalesce(end, F.lit(0.0)) * F.lit(q ** (size * (m - 1)))
        carries[f"_c_{name}"] = carry
        value = F.col(f"_l_{name}") + F.col(f"_c_{name}") * F.lit(q) * down
        result[name] = F.when(F.col(POS) - s.start + 1 >= s.min_periods, value)
    helpers = [*local, *carries]
    return df.withColumns(local).withColumns(carries).withColumns(result).drop(*helpers)


# --- unbounded frames ---------------------------------------------------------------

@dataclass(frozen=True)
class Running:
    """Running aggregate from the first row: ``kind`` is sum, max, min or last.

    ``last`` keeps the latest non-NULL value.  ``strict`` leaves out the current row.
    """

    kind: str
    x: str
    strict: bool = False


def with_running(df: DataFrame, layout: Layout, specs: Mapping[str, Running]) -> DataFrame:
    """Add running aggregates: block-local window plus a carry per block."""
    pick = {"sum": F.sum, "max": F.max, "min": F.min}
    blocks = Window.partitionBy(*layout.keys).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    totals, carries = [], []
    for name, r in specs.items():
        if r.kind == "last":
            total = F.max_by(F.col(r.x), F.when(F.col(r.x).isNotNull(), F.col(POS)))
            carried = F.last(f"_t_{name}", ignorenulls=True).over(blocks)
        else:
            total = pick[r.kind](r.x)
            carried = pick[r.kind](f"_t_{name}").over(blocks)
        totals.append(total.alias(f"_t_{name}"))
        carries.append(carried.alias(f"_k_{name}"))
    at = [*layout.keys, BLOCK]
    carry = df.where(F.col(OWN)).groupBy(*at).agg(*totals).select(*at, *carries)
    joined = df.join(carry, at, "left")
    out = {}
    for name, r in specs.items():
        frame = layout.frame(Window.unboundedPreceding, -1 if r.strict else 0)
        own = F.when(F.col(OWN), F.col(r.x))
        prior = F.col(f"_k_{name}")
        if r.kind == "last":
            out[name] = F.coalesce(F.last(own, ignorenulls=True).over(frame), prior)
        elif r.kind == "sum":
            here = F.sum(own).over(frame)
            out[name] = F.coalesce(here + prior, here, prior)
        else:
            merge = F.greatest if r.kind == "max" else F.least
            out[name] = merge(pick[r.kind](own).over(frame), prior)
    return joined.withColumns(out).drop(*[f"_k_{n}" for n in specs])


@dataclass(frozen=True)
class RunStep:
    """Features built on running aggregates: columns before, the aggregates, columns after.

    Each running aggregate reads the plan below it twice (rows and carries), so steps of
    the same depth are applied together, in one pass.
    """

    prepare: Callable[[DataFrame, Layout], DataFrame]
    specs: Mapping[str, Running]
    finish: Callable[[DataFrame, Layout], DataFrame]

    def __call__(self, df: DataFrame, layout: Layout) -> DataFrame:
        return run_together(df, layout, [self])


def run_together(df: DataFrame, layout: Layout, steps: Sequence[RunStep]) -> DataFrame:
    specs: dict[str, Running] = {}
    for step in steps:
        df = step.prepare(df, layout)
        specs |= step.specs
    df = with_running(df, layout, specs)
    for step in steps:
        df = step.finish(df, layout)
    return df


Build = Callable[[Layout], Mapping[str, Column]]


@dataclass(frozen=True)
class Feature:
    """Columns of one operator, by depth: plain columns, averages of them, columns of those.

    Applying several features together adds all columns of a depth in one projection, so
    the plan grows with the depth, not with the number of features.
    """

    base: Build | None = None
    smooth: Mapping[str, Smooth] = field(default_factory=dict)
    derived: Build | None = None
    smooth_again: Mapping[str, Smooth] = field(default_factory=dict)
    final: Build | None = None
    drop: tuple[str, ...] = ()

    def __call__(self, df: DataFrame, layout: Layout) -> DataFrame:
        return apply_features(df, layout, [self])


def feature_names(layout: Layout, features: Sequence[Feature]) -> list[str]:
    """The columns that ``apply_features`` adds, in its order."""
    names = [c for depth in ("base", "smooth", "derived", "smooth_again", "final") for f in features
             for c in _of_depth(f, depth, layout)]
    left_out = {c for f in features for c in f.drop}
    return [c for c in dict.fromkeys(names) if c not in left_out]


def _of_depth(feature: Feature, depth: str, layout: Layout) -> Mapping:
    made = getattr(feature, depth)
    return made(layout) if callable(made) else made or {}


def apply_features(df: DataFrame, layout: Layout, features: Sequence[Feature]) -> DataFrame:
    def columns(df: DataFrame, depth: str) -> DataFrame:
        made: dict[str, Column] = {}
        for f in features:
            build = getattr(f, depth)
            made |= build(layout) if build else {}
        return df.withColumns(made) if made else df

    def averages(df: DataFrame, depth: str) -> DataFrame:
        specs = {k: v for f in features for k, v in getattr(f, depth).items()}
        return with_smooth(df, layout, specs) if specs else df

    df = averages(columns(df, "base"), "smooth")
    df = averages(columns(df, "derived"), "smooth_again")
    return columns(df, "final").drop(*[c for f in features for c in f.drop])
