"""As-of joins: the latest feed row at or before each bar.

Bars and feed rows are merged in time buckets, so a task holds one bucket of one key
(or of one salt, for market-wide feeds that every series shares).  A table of one row
per bucket carries the last feed row of earlier buckets forward.  The payload is a
struct: a feed row whose values are NULL still counts as the latest row.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window, functions as F

from seriesmill.keys import SERIES_KEYS


BUCKET_STEPS = 4_096


def keep_last(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the last in ``order`` (pre-aggregated, so a hot key is no hot task)."""
    rest = [c for c in df.columns if c not in keys]
    newest = F.max_by(F.struct(*rest), F.struct(*order))
    return df.groupBy(*keys).agg(newest.alias("_r")).select(*keys, *[F.col(f"_r.{c}") for c in rest])


def on_grid(feed: DataFrame, on: Sequence[str], ts: str, grid_ms: int) -> DataFrame:
    """The last feed row up to each grid point, dated at that point."""
    point = F.ceil(F.unix_millis(F.col(ts)) / F.lit(grid_ms)) * F.lit(grid_ms)
    # sub-millisecond parts count as later than the millisecond
    later = F.unix_micros(F.col(ts)) > F.unix_millis(F.col(ts)) * 1000
    exact = F.unix_millis(F.col(ts)) % grid_ms == 0
    point = F.when(exact & later, point + grid_ms).otherwise(point)
    values = [c for c in feed.columns if c not in (*on, ts)]
    # times are unique per key, so column by column gives one row; plain columns keep the
    # aggregation hash-based
    reduced = feed.groupBy(*on, F.timestamp_millis(point).alias("_point")).agg(*[F.max_by(c, ts).alias(c) for c in values])
    return reduced.select(*on, F.col("_point").alias(ts), *values)


def asof_join(bars: DataFrame, feeds: Mapping[str, DataFrame], *, on: Sequence[str] = (),
              ts: str = "ts", bucket_ms: int | None = None, fanout: int = 8,
              salt_by: Sequence[str] = SERIES_KEYS, grid_ms: int | None = None) -> DataFrame:
    """Add one struct column per feed holding its latest row at or before ``ts``.

    ``feeds`` maps the new column to a frame ``(*on, ts, values...)`` with unique
    ``(*on, ts)``.  All feeds travel in one union, so any number of them costs one
    exchange of the bars.  With ``on=()`` the feeds are market-wide: bars are spread
    over ``fanout`` salts per bucket and the (much smaller) feeds are copied to each.

    ``grid_ms`` says that bars start on multiples of that step: only the last feed row
    between two grid points can matter, so feeds are reduced to one row per step before
    they are shuffled, however dense they are.
    """
    if grid_ms:
        feeds = {n: on_grid(f, on, ts, grid_ms) for n, f in feeds.items()}
    bucket_ms = bucket_ms or BUCKET_STEPS * (grid_ms or 3_600_000)
    names = list(feeds)
    bucket = F.floor(F.unix_millis(F.col(ts)) / F.lit(bucket_ms))
    structs = {n: F.struct(*[c for c in f.columns if c not in (*on, ts)]) for n, f in feeds.items()}
    types = {n: f.select(structs[n].alias("p")).schema["p"].dataType for n, f in feeds.items()}
    payload = F.struct(*[c for c in bars.columns if c not in (*on, ts)])
    bar_type = bars.select(payload.alias("b")).schema["b"].dataType
    at = [*on, "_tb", "_salt"]

    salt = F.lit(0) if on else F.pmod(F.xxhash64(*[F.col(c) for c in salt_by]), F.lit(fanout)).cast("int")
    left = bars.select(*on, ts, F.lit(1).alias("_side"), payload.alias("_bar"),
                       *[F.lit(None).cast(types[n]).alias(n) for n in names],
                       bucket.alias("_tb"), salt.alias("_salt"))
    salts = F.lit(0) if on else F.explode(F.sequence(F.lit(0), F.lit(fanout - 1)))
    given = None
    for name, feed in feeds.items():
        part = feed.select(*on, ts, *[(structs[n] if n == name else F.lit(None).cast(types[n])).alias(n) for n in names])
        given = part if given is None else given.unionByName(part)
    if len(names) > 1:
        # times are unique per key and feed: all feeds' rows of one time are one row before they are copied to the salts
        given = given.groupBy(*on, ts).agg(*[F.first(n, ignorenulls=True).alias(n) for n in names])
    merged = left.unionByName(given.select(
        *on, ts, F.lit(0).alias("_side"), F.lit(None).cast(bar_type).alias("_bar"), *names,
        bucket.alias("_tb"), salts.alias("_salt")))

    here = Window.partitionBy(*at).orderBy(ts, "_side").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy(*on, "_salt").orderBy("_tb").rowsBetween(Window.unboundedPreceding, -1)
    per_bucket = merged.groupBy(*at).agg(*[
        F.max_by(F.col(n), F.when(F.col(n).isNotNull(), F.col(ts))).alias(n) for n in names])
    carry = per_bucket.select(*at, *[
        F.last(n, ignorenulls=True).over(before).alias(f"_k_{n}") for n in names])
    latest = merged.select(*at, ts, "_side", "_bar", *[
        F.last(n, ignorenulls=True).over(here).alias(n) for n in names]).where("_side = 1")
    out = latest.join(carry, at, "left")
    return out.select(*on, ts, "_bar.*", *[F.coalesce(F.col(n), F.col(f"_k_{n}")).alias(n) for n in names])


def asof_columns(bars: DataFrame, feeds: Mapping[str, DataFrame], *, prefix: str = "",
                 **options) -> DataFrame:
    """As-of join with the feed columns spread out (and prefixed)."""
    on = options.get("on", ())
    ts = options.get("ts", "ts")
    hidden = {f"_feed_{i}": f for i, f in enumerate(feeds.values())}
    joined = asof_join(bars, hidden, **options)
    spread = [F.col(f"{h}.{c}").alias(f"{prefix}{c}")
              for h, f in hidden.items() for c in f.columns if c not in (*on, ts)]
    return joined.select(*bars.columns, *spread)
