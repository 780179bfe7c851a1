"""Training sets: chronological splits, train-only scaling, sequence windows, class weights."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from seriesmill.functions.scalar import is_finite, map_ids
from seriesmill.keys import ASSET_IDS, CYCLE_IDS, REGIME_IDS, TIMEFRAME_IDS
from seriesmill.plans import wide
from seriesmill.plans.blocks import BLOCK, OWN, POS, TOTAL, Layout, to_blocks, with_positions
from seriesmill.plans.materialize import sized

TRAIN_SHARE, VALIDATION_SHARE, EMBARGO_BARS = 0.70, 0.15, 10
# Steps of a sample's window per timeframe.
SEQUENCE_LENGTHS = {"15m": 128, "1h": 128, "4h": 96, "1d": 90}


def join_labels(features: DataFrame, labels: DataFrame, keys: Sequence[str], ts: str = "ts") -> DataFrame:
    """Inner join on series and time, unusable directions left out."""
    return features.join(labels, [*keys, ts]).where(F.col("direction").isin(0, 1, 2))


def _positions(df: DataFrame, layout: Layout) -> DataFrame:
    bucket = F.floor(F.unix_millis(F.col(layout.ts)) / F.lit(layout.bucket_ms))
    return with_positions(df, layout.keys, bucket, [layout.ts])


def add_split(df: DataFrame, layout: Layout, train: float = TRAIN_SHARE, validation: float = VALIDATION_SHARE,
              embargo: int = EMBARGO_BARS, purge: bool = False, name: str = "split") -> DataFrame:
    """train / val / test by position in the series, with a gap before val and test.

    Rows inside a gap get NULL.  ``purge`` also drops rows whose label looks into the
    next part (position + ``barrier_hit_offset``).
    """
    df = _positions(df, layout)
    train_end = F.floor(F.col(TOTAL) * F.lit(train))
    val_end = train_end + F.floor(F.col(TOTAL) * F.lit(validation))
    reach = F.col(POS) + (F.coalesce(F.col("barrier_hit_offset"), F.lit(0.0)) if purge else F.lit(0.0))
    part = (F.when((F.col(POS) < train_end) & (reach < train_end if purge else F.lit(True)), "train")
            .when((F.col(POS) >= train_end + embargo) & (F.col(POS) < val_end)
                  & (reach < val_end if purge else F.lit(True)), "val")
            .when(F.col(POS) >= val_end + embargo, "test"))
    return df.withColumn(name, part)


def walk_forward(df: DataFrame, layout: Layout, folds: int = 5, train_days: int = 365, validation_days: int = 90,
                 test_days: int = 90) -> DataFrame:
    """Rows with their (fold, split) memberships; the training part grows by one test part per fold."""
    first = sized(df.groupBy(*layout.keys).agg(F.min(layout.ts).alias("_t0")))
    joined = df.join(first, list(layout.keys))
    day = (F.unix_millis(F.col(layout.ts)) - F.unix_millis("_t0")) / F.lit(86_400_000)
    parts = []
    for k in range(folds):
        a = train_days + k * test_days
        b, c = a + validation_days, a + validation_days + test_days
        part = F.when(day < a, "train").when(day < b, "val").when(day < c, "test")
        parts.append(F.struct(F.lit(k).alias("fold"), part.alias("split")))
    return (joined.withColumn("_p", F.explode(F.array(*parts)))
            .select(*df.columns, F.col("_p.fold").alias("fold"), F.col("_p.split").alias("split"))
            .where(F.col("split").isNotNull()))


def fit_medians(df: DataFrame, keys: Sequence[str], columns: Sequence[str], train: Column) -> DataFrame:
    """Exact training medians of all columns: ``keys, feature, median``."""
    return wide.quantiles(df.where(train), keys, columns, [0.5]).select(*keys, "feature", F.col("q").alias("median"))


def fit_scaler(df: DataFrame, keys: Sequence[str], columns: Sequence[str], train: Column,
               medians: DataFrame | None = None) -> DataFrame:
    """Median, mean and population deviation of the imputed training rows, per feature.

    The moments of the values at hand come from one wide aggregation; the imputed rows, all at the
    median, are added to them by their number.
    """
    at, columns = [*keys, "feature"], list(columns)
    medians = sized(fit_medians(df, keys, columns, train) if medians is None else medians)
    value = lambda c: F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double"))
    one = df.where(train).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), *[
        F.struct(F.count(value(c)).alias("m"), F.avg(value(c)).alias("mean"), F.var_pop(value(c)).alias("var")).alias(f"_c{i}")
        for i, c in enumerate(columns)])
    # one row per series: its columns become rows
    long = one.select(*keys, "_n", F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(f"_c{i}").alias("s")) for i, c in enumerate(columns)])).alias("_x")).select(
        *keys, "_n", "_x.feature", "_x.s.*")
    m, k = F.col("m"), F.col("_n") - F.col("m")
    mean = (m * F.col("mean") + k * F.col("median")) / F.col("_n")
    spread = lambda x: (F.col(x) - F.col("_mean")) * (F.col(x) - F.col("_mean"))
    var = (m * (F.col("var") + spread("mean")) + k * spread("median")) / F.col("_n")
    return long.join(medians, at).withColumn("_mean", F.when(k == 0, F.col("mean")).otherwise(mean)).select(
        *at, "median", F.col("_mean").alias("mean"), F.sqrt(F.when(k == 0, F.col("var")).otherwise(var)).alias("std"))


def scale(df: DataFrame, keys: Sequence[str], columns: Sequence[str], scaler: DataFrame) -> DataFrame:
    """Impute and standardise; what is still not finite (e.g. no training value) becomes 0."""
    columns = list(columns)
    entry = F.struct("feature", F.struct("median", "mean", "std").alias("s"))
    # one row per series, its entries in the order of the columns
    maps = scaler.groupBy(*keys).agg(F.map_from_entries(F.collect_list(entry)).alias("_m"))
    ordered = sized(maps.select(*keys, F.transform(F.array(*[F.lit(c) for c in columns]), lambda c: F.try_element_at("_m", c)).alias("_s")))
    joined = df.join(ordered, list(keys), "left")
    out = {}
    for i, c in enumerate(columns):
        s = F.get("_s", F.lit(i))
        spread = F.when(s["std"] == 0, 1.0).otherwise(s["std"])
        z = F.try_divide(F.coalesce(F.col(c), s["median"]) - s["mean"], spread)
        out[c] = F.when(is_finite(z), z).otherwise(0.0)
    return joined.withColumns(out).drop("_s")


def add_sequence(df: DataFrame, L: Layout, columns: Sequence[str], length: int, name: str = "x_seq") -> DataFrame:
    """The last ``length`` rows of ``columns`` as an array of arrays; NULL where too few exist."""
    step = F.array(*[F.col(c).cast("double") for c in columns])
    rows = F.collect_list(step).over(L.frame(-(length - 1)))
    return df.withColumn(name, F.when(F.col(POS) >= length - 1, rows))


def targets(df: DataFrame) -> DataFrame:
    """The rows with their ids and the four targets as numbers."""
    return df.withColumns({
        "asset_id": map_ids(F.col("symbol"), ASSET_IDS, 0), "tf_id": map_ids(F.col("timeframe"), TIMEFRAME_IDS, 1),
        "y_direction": F.col("direction").cast("int"),
        "y_regime": map_ids(F.col("regime"), REGIME_IDS, REGIME_IDS["ranging_low_vol"]),
        "y_cycle": map_ids(F.col("cycle"), CYCLE_IDS, CYCLE_IDS["accumulation"]),
        "y_trade_quality": F.col("trade_quality").cast("int")})


def sample_rows(df: DataFrame, layout: Layout, length: int) -> DataFrame:
    """The rows that end a sample: ``length`` rows of their series are there and they belong to a split.

    A sample is its last row; its window is read from the rows before it (``over_windows``), never stored.
    """
    rows = _positions(df, layout).where((F.col(POS) >= length - 1) & F.col("split").isNotNull())
    return targets(rows).drop(POS, TOTAL)


@dataclass
class Windows:
    """The windows of some samples as views of the rows of one block.

    ``rows`` (rows x columns) is in time order; sample i ends at row ``ends[i]``; ``carried`` has further columns of the
    samples' last rows.
    """

    rows: np.ndarray
    ends: np.ndarray
    length: int
    carried: pa.Table

    def all(self) -> np.ndarray:
        """A view of samples x columns x steps for ends in a row; indexing it copies."""
        view = np.lib.stride_tricks.sliding_window_view(self.rows, self.length, axis=0)
        return view[self.ends - self.length + 1]

    def project(self, weights: np.ndarray) -> np.ndarray:
        """Sum over steps of ``row @ weights[step]``: samples x outputs, without a copy of any window."""
        steps, columns, outputs = weights.shape
        each = (self.rows @ weights.transpose(1, 0, 2).reshape(columns, steps * outputs)).reshape(-1, steps, outputs)
        return sum((each[self.ends - self.length + 1 + k, k] for k in range(steps)), np.zeros((len(self.ends), outputs)))

    def gather(self, values: np.ndarray) -> np.ndarray:
        """Sum over samples of the outer product of each step's row and the sample's ``values``: steps x columns x outputs."""
        spread = np.zeros((len(self.rows), self.length, values.shape[1]))
        for k in range(self.length):
            spread[self.ends - self.length + 1 + k, k] = values
        flat = self.rows.T @ spread.reshape(len(self.rows), -1)
        return flat.reshape(self.rows.shape[1], self.length, -1).transpose(1, 0, 2)


def window_blocks(df: DataFrame, layout: Layout, sequence: Sequence[str], length: int, carry: Sequence[str]) -> DataFrame:
    """The rows laid out in blocks, each with the rows its first windows reach back to."""
    L = layout.reach(before=length - 1)
    names = list(dict.fromkeys([*layout.keys, layout.ts, "split", *sequence, *carry]))
    return to_blocks(df.select(*names), L)


def over_windows(blocks: DataFrame, layout: Layout, sequence: Sequence[str], length: int, carry: Sequence[str],
                 each: Callable[[Windows], pa.Table], schema: str) -> DataFrame:
    """What ``each`` makes of the samples of every block; a task holds one block of rows at a time."""
    sequence, carry = list(sequence), list(carry)

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by(POS)
        rows = np.stack([table.column(c).to_numpy().astype(np.float64) for c in sequence], axis=1)
        own = table.column(OWN).to_numpy() & table.column("split").is_valid().to_numpy()
        ends = np.flatnonzero(own & (table.column(POS).to_numpy() >= length - 1))
        return each(Windows(rows, ends, length, table.select(carry).take(pa.array(ends))))

    return blocks.groupBy(*layout.keys, BLOCK).applyInArrow(run, schema)


def class_weights(df: DataFrame, label: str = "y", classes: int = 3) -> DataFrame:
    """1/sqrt(count) per class, normalised to mean 1; an absent class counts as one row."""
    counts = df.groupBy(F.col(label).alias("_c")).agg(F.count(F.lit(1)).alias("_n"))
    grid = df.sparkSession.range(classes).select(F.col("id").cast("int").alias("label"))
    full = grid.join(counts, F.col("label") == F.col("_c"), "left")
    raw = full.select("label", F.coalesce("_n", F.lit(0)).alias("rows"),
                      (1 / F.sqrt(F.greatest(F.coalesce("_n", F.lit(0)), F.lit(1)).cast("double"))).alias("_w"))
    every = Window.partitionBy(F.lit(0))  # one row per class
    return raw.select("label", "rows", (F.col("_w") / F.avg("_w").over(every)).alias("weight"))


def dataset_spec(samples: DataFrame, keys: Sequence[str], sequence: int, context: int, length: int,
                 embargo: int = EMBARGO_BARS) -> DataFrame:
    """Sample counts per split and the shape of the inputs."""
    count = lambda s: F.sum(F.when(F.col("split") == s, 1).otherwise(0)).cast("bigint")
    return samples.groupBy(*keys).agg(
        count("train").alias("train_rows"), count("val").alias("val_rows"), count("test").alias("test_rows"),
        F.lit(length).cast("bigint").alias("seq_len"), F.lit(embargo).cast("bigint").alias("embargo_bars"),
        F.lit(sequence).cast("bigint").alias("feature_count_seq"),
        F.lit(context).cast("bigint").alias("feature_count_context"))
