"""Alert payloads, gates and the cooldown, for batch frames and streams."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from seriesmill.functions.scalar import UNAVAILABLE, rnd
from seriesmill.operators.asof import asof_join
from seriesmill.plans.blocks import OWN, Layout, Running, lag, to_blocks, with_running
from seriesmill.plans.materialize import settle

# Gates, warnings and the signals that may alert.
MIN_CONFIDENCE, MIN_QUALITY, COOLDOWN_MINUTES = 0.65, 0.60, 60
ACTIONABLE = ("long_bias", "short_bias")
WARNINGS = ("Decision-support only. Not financial advice.", "Validate manually before trading.")
SCORECARD_FIELDS = {
    "trend": "trend_direction", "ema_stack": "structure_state", "rsi": "rsi_14", "macd": "macd_state", "funding": "funding_state",
    "open_interest": "open_interest_change_pct", "fear_greed": "fear_greed_state", "data_coverage_score": "onchain_coverage_score",
}


def alert_payload(scorecard: Column | None = None, references: dict[str, Column] | None = None) -> Column:
    """The alert of a prediction row as a struct.

    Reads ``ts, model_id, asset, timeframe, signal, p_down, p_sideways, p_up, quality,
    regime, cycle``; ``scorecard`` is a map of texts; ``references`` may hold the price levels
    (0 where absent) and ``liquidation_buffer_pct`` (NULL where absent).
    """
    refs = references or {}
    card = F.struct(*[
        (F.coalesce(F.try_element_at(scorecard, F.lit(src)), F.lit(UNAVAILABLE)) if scorecard is not None else F.lit(UNAVAILABLE)).alias(name)
        for name, src in SCORECARD_FIELDS.items()])
    known = lambda c, default="unknown": F.coalesce(F.col(c), F.lit(default))
    return F.struct(
        F.lit("model_signal").alias("alert_type"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'+00:00'").alias("timestamp_utc"),
        known("model_id").alias("model_id"), known("asset").alias("asset"), known("timeframe").alias("timeframe"),
        known("signal", "no_trade").alias("signal"),
        rnd(F.array_max(F.array("p_down", "p_sideways", "p_up")), 4).alias("direction_confidence"),
        rnd(F.coalesce(F.col("quality"), F.lit(0.0)), 4).alias("trade_quality_probability"),
        known("regime").alias("regime"), known("cycle").alias("cycle_phase"),
        *[F.coalesce(refs[k], F.lit(0.0)).alias(k) if k in refs else F.lit(0.0).alias(k)
          for k in ("entry_reference", "stop_reference", "tp1_reference", "tp2_reference", "tp3_reference")],
        F.lit(2.0).alias("estimated_rr"), F.lit(1.0).alias("risk_per_trade_pct"), F.lit(1).alias("leverage"),
        refs.get("liquidation_buffer_pct", F.lit(None)).cast("double").alias("liquidation_buffer_pct"),
        card.alias("scorecard"), F.array(*[F.lit(w) for w in WARNINGS]).alias("warnings"), F.lit(COOLDOWN_MINUTES).alias("cooldown_minutes"))


def gate_reason(signal: Column, confidence: Column, quality: Column, stale: Column | None = None, coverage_ok: Column | None = None,
                minutes_since_last: Column | None = None, min_confidence: float = MIN_CONFIDENCE, min_quality: float = MIN_QUALITY,
                cooldown: int = COOLDOWN_MINUTES) -> Column:
    """Why an alert is held back, or ``all gates passed``; gates apply in order (fixed values: the reason texts)."""
    no = F.lit(False)
    since = minutes_since_last if minutes_since_last is not None else F.lit(None).cast("double")
    text = lambda *parts: F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts])
    # the payload's values have four decimals; printed without closing zeros, but with one decimal at least
    four = lambda x: F.regexp_replace(F.regexp_replace(F.format_string("%.4f", x), "0+$", ""), r"\.$", ".0")
    return (
        F.when(~signal.isin(*ACTIONABLE) | signal.isNull(), text("signal '", F.coalesce(signal, F.lit("None")), "' is non-alerting"))
        .when(stale if stale is not None else no, "model is stale")
        .when(~(coverage_ok if coverage_ok is not None else ~no), "data coverage below acceptable threshold")
        .when(confidence < min_confidence, text("direction confidence ", four(confidence), f" < {min_confidence}"))
        .when(quality < min_quality, text("trade quality ", four(quality), f" < {min_quality}"))
        .when(since < cooldown, text("cooldown active (", F.format_string("%.0f", since), f" < {cooldown} min)"))
        .otherwise("all gates passed"))


# --- cooldown -----------------------------------------------------------------------

def kept_alerts(alerts: DataFrame, layout: Layout, minutes: int = COOLDOWN_MINUTES, long_segment: int = 2_000) -> DataFrame:
    """Alerts at least ``minutes`` after the last kept one of their series (unique times per series).

    An alert that follows a pause of ``minutes`` is always kept, so the series falls into
    independent segments.  Short segments are folded in order; long ones follow the links
    "next alert that may be kept" with doubling jumps, in a few joins spread over all rows.
    """
    keys, gap = list(layout.keys), minutes * 60_000
    L = layout.reach(before=1)
    df = to_blocks(alerts.select(*keys, layout.ts), L).withColumn("_t", F.unix_millis(layout.ts))
    before = lag(L, "_t")
    df = df.withColumn("_start", F.when(before.isNull() | (F.col("_t") - before >= gap), F.col("_t")))
    df = with_running(df, L, {"_seg": Running("last", "_start")})
    rows = settle(df.where(F.col(OWN)).select(*keys, "_seg", "_t"))
    at = [*keys, "_seg"]
    sizes = rows.groupBy(*at).agg(F.count(F.lit(1)).alias("_n"))
    lists = rows.join(sizes.where(F.col("_n") <= long_segment), at).groupBy(*at).agg(F.array_sort(F.collect_list("_t")).alias("_a"))
    start = F.struct(F.lit(None).cast("bigint").alias("last"), F.array().cast("array<bigint>").alias("kept"))
    step = lambda s, t: F.when(s["last"].isNull() | (t - s["last"] >= gap), F.struct(
        t.alias("last"), F.concat(s["kept"], F.array(t)).alias("kept"))).otherwise(s)
    kept = lists.select(*keys, F.explode(F.aggregate("_a", start, step)["kept"]).alias("_t"))
    long = settle(rows.join(sizes.where(F.col("_n") > long_segment).drop("_n"), at))
    if not long.isEmpty():
        kept = kept.unionByName(_follow_links(long, at, gap).select(*keys, "_t"))
    return kept.select(*keys, F.timestamp_millis("_t").alias(layout.ts))


def _follow_links(rows: DataFrame, at: Sequence[str], gap: int) -> DataFrame:
    """Rows reachable from each segment's first row by "first row at least ``gap`` later"."""
    # the first later row is the last earlier one when time runs backwards
    back = lambda t: F.timestamp_millis(-t)
    left = rows.select(*at, "_t", back(F.col("_t") + gap).alias("ts"))
    right = rows.select(*at, F.col("_t").alias("_next"), back(F.col("_t")).alias("ts"))
    jump = settle(asof_join(left, {"_f": right}, on=at, bucket_ms=gap * 256)
                  .select(*at, "_t", F.col("_f._next").alias("_next")).where("_next IS NOT NULL"))
    reached = settle(rows.where(F.col("_t") == F.col("_seg")).select(*at, "_t"))
    while not jump.isEmpty():
        landed = reached.join(jump, [*at, "_t"]).select(*at, F.col("_next").alias("_t"))
        reached = settle(reached.unionByName(landed))
        onward = jump.select(*at, F.col("_t").alias("_next"), F.col("_next").alias("_far"))
        jump = settle(jump.join(onward, [*at, "_next"]).select(*at, "_t", F.col("_far").alias("_next")))
    return reached


def stream_kept_alerts(alerts: DataFrame, keys: Sequence[str], minutes: int = COOLDOWN_MINUTES, ts: str = "ts") -> DataFrame:
    """The same on a stream: the time of the last kept alert is the state of each series."""
    gap = minutes * 60_000
    schema = alerts.select(*keys, ts).schema
    out_schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema.fields)

    def keep(key, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        times = pd.concat([b[ts] for b in batches]).sort_values()
        last = state.get[0] if state.exists else None
        kept = []
        for stamp, t in zip(times, times.astype("datetime64[us, UTC]" if times.dt.tz is not None else "datetime64[us]").astype("int64") // 1000):
            if last is None or t - last >= gap:
                kept.append(stamp)
                last = int(t)
        if last is not None:
            state.update((last,))
        yield pd.DataFrame({**{k: [v] * len(kept) for k, v in zip(keys, key)}, ts: kept})

    return alerts.select(*keys, ts).groupBy(*keys).applyInPandasWithState(
        keep, out_schema, "last_ms bigint", "append", "NoTimeout")


