"""Feature selection: missing values, variance, correlation, mutual information, permutation."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from seriesmill.functions.scalar import is_finite
from seriesmill.plans import wide
from seriesmill.plans.blocks import POS, TOTAL, with_positions
from seriesmill.plans.gram import correlations
from seriesmill.plans.materialize import settle
from seriesmill.session import ensure_checkpoint_dir

# Stage thresholds and the features every selection keeps when present.
MIN_NON_NULL, MIN_VARIANCE, MAX_CORRELATION = 0.85, 1e-6, 0.95
MUTUAL_INFO_TOP, PERMUTATION_TOP, FINAL_TOP = 160, 140, 120
#: Rows of a bucket in which a task numbers the rows by hash.
NUMBERED = 8_192
ALWAYS_KEEP = (
    "close", "volume", "returns_1", "atr", "rsi_14", "macd_hist", "ema_stack_score", "realized_volatility",
    "funding_rate", "open_interest_change_pct", "fear_greed", "btc_dominance_pct", "cycle_months_since_halving",
)


def null_ratios(df: DataFrame, columns: Sequence[str], minimum: float = MIN_NON_NULL) -> DataFrame:
    """Share of present values per column and whether the column stays."""
    one = df.agg(*[F.avg(F.col(c).isNotNull().cast("double")).alias(c) for c in columns])
    return one.unpivot([], list(columns), "feature", "ratio").withColumn("kept", F.col("ratio") >= minimum)


def variances(df: DataFrame, columns: Sequence[str], minimum: float = MIN_VARIANCE) -> DataFrame:
    one = df.agg(*[F.var_pop(F.col(c).cast("double")).alias(c) for c in columns])
    return one.unpivot([], list(columns), "feature", "variance").withColumn(
        "kept", F.coalesce(F.col("variance") > minimum, F.lit(False)))


def correlated_drops(pairs: DataFrame, threshold: float = MAX_CORRELATION, always_keep: Sequence[str] = ()) -> list[tuple[str, str, str]]:
    """Greedy pass over the strong pairs in column order: (dropped, first, second).

    Only pairs above the threshold come to the driver: at most columns^2 rows, whatever
    the data size.
    """
    strong = pairs.where(F.abs("r") > threshold).orderBy("_b", "_a").select("a", "b").collect()
    dropped: dict[str, tuple[str, str]] = {}
    for a, b in strong:
        loser = a if b in always_keep else b
        if loser not in always_keep and loser not in dropped:
            dropped[loser] = (a, b)
    return [(k, *v) for k, v in dropped.items()]


def mutual_information(df: DataFrame, columns: Sequence[str], label: str, bins: int = 10) -> DataFrame:
    """Mutual information (nats) of each column, cut at its quantiles, with the label.

    A missing value counts as 0, as in the ranking this stands for.  The label has few values, as classes do.
    """
    columns = list(columns)
    filled = df.select(F.col(label).alias("_y"), *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in columns])
    cuts = wide.quantiles(filled, [], columns, [k / bins for k in range(1, bins)])
    edges = settle(cuts.groupBy("feature").agg(F.array_sort(F.collect_set("q")).alias("edges")))
    labels = sorted(r["_y"] for r in filled.select("_y").distinct().collect() if r["_y"] is not None)
    marks = {f"_y{k}": f"_y = {y!r}" for k, y in enumerate(labels)}
    cells = settle(wide.bin_counts(filled, [], columns, edges, marks))
    counts = F.array(*[F.col(m).cast("double") for m in marks])
    at = Window.partitionBy("feature")  # at most ``bins`` rows per feature
    placed = cells.select("feature", "bin", counts.alias("_n")).withColumns({
        "_nb": F.aggregate("_n", F.lit(0.0), lambda a, x: a + x),
        "_ny": F.array(*[F.sum(F.col("_n")[k]).over(at) for k in range(len(labels))])})
    total = F.aggregate("_ny", F.lit(0.0), lambda a, x: a + x)
    terms = F.transform(F.arrays_zip("_n", "_ny"), lambda e: F.when(
        e["_n"] > 0, e["_n"] / total * F.ln(e["_n"] * total / (F.col("_nb") * e["_ny"]))).otherwise(0.0))
    one = placed.select("feature", F.aggregate(terms, F.lit(0.0), lambda a, x: a + x).alias("_t"))
    return one.groupBy("feature").agg(F.greatest(F.sum("_t"), F.lit(0.0)).alias("score"))


@dataclass
class Trees:
    """Boosted regression trees as arrays: one row per tree, one entry per node (node 0 is the root)."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    weights: np.ndarray
    depth: int

    @classmethod
    def of(cls, model: GBTClassificationModel) -> Trees:
        """From the node table that the model writes when it is saved."""
        spark = SparkSession.active()
        path = f"{ensure_checkpoint_dir(spark)}/trees-{uuid.uuid4().hex}"
        model.write().save(path)
        nodes = spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*").collect()  # 2^depth nodes a tree
        shape = len(model.treeWeights), 1 + max((r["id"] for r in nodes), default=0)
        out = cls(np.full(shape, -1), np.zeros(shape), np.zeros(shape, dtype=int), np.zeros(shape, dtype=int), np.zeros(shape),
                  np.array(model.treeWeights), max((t.depth for t in model.trees), default=0))
        for r in nodes:
            at = r["treeID"], r["id"]
            out.value[at] = r["prediction"]
            if r["leftChild"] >= 0:
                out.feature[at], out.threshold[at] = r["split"]["featureIndex"], r["split"]["leftCategoriesOrThreshold"][0]
                out.left[at], out.right[at] = r["leftChild"], r["rightChild"]
        return out

    def uses(self, column: int) -> np.ndarray:
        """The trees that split on a column."""
        return np.flatnonzero((self.feature == column).any(axis=1))

    def margins(self, x: np.ndarray, which: np.ndarray) -> np.ndarray:
        """Weighted predictions of some trees: trees x rows."""
        out = np.zeros((len(which), len(x)))
        for k, t in enumerate(which):
            node = np.zeros(len(x), dtype=int)
            for _ in range(self.depth):
                split = self.feature[t, node]
                goes = np.where(x[np.arange(len(x)), np.maximum(split, 0)] <= self.threshold[t, node], self.left[t, node], self.right[t, node])
                node = np.where(split >= 0, goes, node)
            out[k] = self.weights[t] * self.value[t, node]
        return out


def swapped_hits(trees: Trees, x: np.ndarray, other: np.ndarray, columns: Sequence[int], y: np.ndarray,
                 every: np.ndarray | None = None) -> dict[int, int]:
    """Right predictions when each of the ``columns`` in turn takes its values from ``other`` (rows x columns).

    Only the trees that split on the column are looked at again, and the rows are copied once, not per column.
    ``every`` is what all trees say of ``x``, where it is known.
    """
    every = trees.margins(x, np.arange(len(trees.weights))) if every is None else every
    whole, hits, changed = every.sum(axis=0), {}, x.copy()
    for k, c in enumerate(columns):
        which = trees.uses(c)
        changed[:, c] = other[:, k]
        margin = whole - every[which].sum(axis=0) + trees.margins(changed, which).sum(axis=0)
        changed[:, c] = x[:, c]
        hits[c] = int(((margin > 0) == (y > 0)).sum())
    return hits


def permutation_importance(df: DataFrame, columns: Sequence[str], label: str, ids: Sequence[str], repeats: int = 5,
                           seed: int = 42, trees: int = 80, depth: int = 3) -> DataFrame:
    """Mean loss of accuracy when a column is shuffled, for a boosted-tree model fit on ``df``.

    One join per repeat: rows are numbered in two orders (by id hash), so a row meets one other row.  All columns are
    swapped inside the tasks, against the broadcast trees; no row is copied per column.  A column no tree splits on
    scores 0.  A value that is missing or not finite (which a vector may not hold) counts as 0; rows without a label
    are left out; without rows there are no scores.
    """
    columns = list(columns)
    value = lambda c: F.when(is_finite(F.col(c)), F.col(c).cast("double")).otherwise(0.0)
    data = settle(df.where(F.col(label).isNotNull()).select(
        *ids, F.col(label).cast("double").alias("_y"), *[value(c).alias(c) for c in columns]))
    n = data.count()
    if not n:
        return data.sparkSession.createDataFrame([], "feature string, score double")
    assemble = VectorAssembler(inputCols=columns, outputCol="features")
    model = GBTClassifier(labelCol="_y", maxIter=trees, maxDepth=depth, seed=seed).fit(assemble.transform(data))
    known = Trees.of(model)
    used = [c for c in range(len(columns)) if len(known.uses(c))]
    shared = data.sparkSession.sparkContext.broadcast(known)

    # the first bits of a hash: buckets of some thousand rows, so the table of their offsets stays small
    shift = 63 - max(0, (n // NUMBERED).bit_length())

    def numbered(salt: int) -> DataFrame:
        h = F.xxhash64(*[F.col(c) for c in ids], F.lit(salt))
        return with_positions(data.withColumn("_h", h), (), F.shiftright(F.col("_h"), shift), ["_h", *ids]).drop(TOTAL, "_h")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x, y = batch[[f"_x{i}" for i in range(len(columns))]].to_numpy(float), batch["_y"].to_numpy()
            other = batch[[f"_o{i}" for i in used]].to_numpy(float)
            every = shared.value.margins(x, np.arange(len(shared.value.weights)))
            base = int(((every.sum(axis=0) > 0) == (y > 0)).sum())
            hits = {c: base for c in range(len(columns))} | swapped_hits(shared.value, x, other, used, y, every)
            yield pd.DataFrame({"c": list(hits), "hits": list(hits.values()), "base": base, "n": len(batch)})

    rows = numbered(seed).select(POS, "_y", *[F.col(c).alias(f"_x{i}") for i, c in enumerate(columns)])
    parts = []
    for k in range(repeats):
        other = numbered(seed + 1 + k).select(F.col(POS).alias("_at"), *[F.col(columns[i]).alias(f"_o{i}") for i in used])
        parts.append(rows.join(other, F.col(POS) == F.col("_at")).drop("_at"))
    shuffled = parts[0]
    for part in parts[1:]:
        shuffled = shuffled.unionByName(part)
    counted = shuffled.mapInPandas(run, "c int, hits bigint, base bigint, n bigint").groupBy("c").agg(
        *[F.sum(c).alias(c) for c in ("hits", "base", "n")])
    return counted.select(F.array(*[F.lit(c) for c in columns])[F.col("c")].alias("feature"), ((F.col("base") - F.col("hits")) / F.col("n")).alias("score"))


def select_features(train: DataFrame, validation: DataFrame, columns: Sequence[str], label: str, ids: Sequence[str],
                    always_keep: Sequence[str] = ALWAYS_KEEP, final_top: int = FINAL_TOP, **permutation) -> DataFrame:
    """All stages in order; one row per feature with its stage, score and whether it is kept.

    The first four stages read training rows only.  What a stage hands on is a list of
    column names.
    """
    spark = train.sparkSession
    columns = list(columns)
    report: dict[str, tuple[str, float | None, bool]] = {}
    stats = {r["feature"]: r for r in null_ratios(train, columns).join(variances(train, columns).drop("kept"), "feature").collect()}
    keep = []
    for c in columns:
        if stats[c]["ratio"] < MIN_NON_NULL:
            report[c] = ("null_ratio", stats[c]["ratio"], False)
        elif not (stats[c]["variance"] or 0.0) > MIN_VARIANCE:
            report[c] = ("variance", stats[c]["variance"], False)
        else:
            keep.append(c)
    for loser, _, _ in correlated_drops(correlations(train, keep), always_keep=always_keep) if len(keep) > 1 else []:
        report[loser] = ("correlation", None, False)
        keep.remove(loser)
    ranked = mutual_information(train, keep, label).orderBy(F.col("score").desc(), "feature").limit(MUTUAL_INFO_TOP).collect()
    by_info = [r["feature"] for r in ranked]
    for c in set(keep) - set(by_info):
        report[c] = ("mutual_information", None, False)
    perm = permutation_importance(validation, by_info, label, ids, **permutation).orderBy(
        F.col("score").desc(), "feature").limit(PERMUTATION_TOP).collect()
    scores = {r["feature"]: r["score"] for r in perm}
    order = list(dict.fromkeys([*[c for c in always_keep if c in keep], *(scores or by_info)]))
    chosen = order[:max(final_top, sum(c in keep for c in always_keep))]
    for c in {*by_info, *order}:
        report[c] = ("permutation", scores.get(c), c in chosen)
    return spark.createDataFrame([(c, *v) for c, v in report.items()], "feature string, stage string, score double, kept boolean")
