"""Column expressions with the missing-value rules every operator shares."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from datetime import date, datetime, timezone
from itertools import chain

from pyspark.sql import Column, functions as F

from seriesmill.keys import TIMEFRAME_MS

UNAVAILABLE = "unavailable"
# a score that equals its limit must not pass it because of the order its sums were taken in
TIE = 1e-12


def col(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def flag(condition: Column) -> Column:
    """1.0 / 0.0; a comparison with a missing value counts as false."""
    return F.coalesce(condition, F.lit(False)).cast("double")


def safe_div(a: Column, b: Column) -> Column:
    """Division that gives NULL for a zero or missing divisor."""
    return F.try_divide(a, b)


def clean(x: Column | str) -> Column:
    """NaN becomes NULL."""
    return F.nanvl(col(x).cast("double"), F.lit(None).cast("double"))


def is_finite(x: Column) -> Column:
    return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))


def timeframe_ms(timeframe: Column) -> Column:
    """Bar length in ms; an unknown timeframe fails the job."""
    table = F.create_map(*chain.from_iterable((F.lit(k), F.lit(v)) for k, v in TIMEFRAME_MS.items()))
    found = F.try_element_at(table, timeframe)
    return F.coalesce(found, F.raise_error(F.concat(F.lit("Unsupported timeframe: "), timeframe)).cast("bigint"))


def map_ids(x: Column, ids: Mapping[str, int], default: int) -> Column:
    table = F.create_map(*chain.from_iterable((F.lit(k), F.lit(v)) for k, v in ids.items()))
    return F.coalesce(F.try_element_at(table, x), F.lit(default))


def classify(x: Column, steps: Iterable[tuple[float, str]]) -> Column:
    """Ascending thresholds to labels; missing gives ``unavailable``, above the last gives the last label."""
    steps = list(steps)
    out = F.when(x.isNull() | F.isnan(x), F.lit(UNAVAILABLE))
    for limit, label in steps:
        out = out.when(x <= F.lit(float(limit)), F.lit(label))
    return out.otherwise(F.lit(steps[-1][1]))


def to_ms(ts: Column) -> Column:
    return F.unix_millis(ts)


def from_ms(ms: Column) -> Column:
    return F.timestamp_millis(ms)


def last_anchor(ts: Column, anchors: Iterable[str | date]) -> Column:
    """Latest anchor at or before ``ts``, from a short literal list (no join)."""
    points = [datetime.combine(date.fromisoformat(str(a)), datetime.min.time(), timezone.utc) for a in anchors]
    seconds = F.array(*[F.lit(int(p.timestamp())).cast("bigint") for p in points])
    earlier = F.filter(seconds, lambda a: a <= F.unix_seconds(ts))
    return F.timestamp_seconds(F.array_max(earlier))


def months_since(ts: Column, anchor: Column) -> Column:
    """Whole days since the anchor, in mean months of 30.4375 days."""
    days = F.floor((F.unix_seconds(ts) - F.unix_seconds(anchor)) / F.lit(86400))
    return days.cast("double") / F.lit(30.4375)


def rnd(x: Column | str, digits: int = 6) -> Column:
    """Round for comparison across engines; adding 0.0 removes a negative zero."""
    value = col(x).cast("double")
    return F.when(F.abs(value) == float("inf"), value).otherwise(F.round(value, digits) + F.lit(0.0))
