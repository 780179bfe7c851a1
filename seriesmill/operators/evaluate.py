"""Classification quality: confusion, per-class scores, ranking scores, calibration, baselines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from seriesmill.plans.blocks import Layout, Rolling, Running, from_blocks, to_blocks, with_running
from seriesmill.plans.materialize import with_scalars
from seriesmill.plans.prefix import totals_below

CLASSES = (0, 1, 2)


def _ratio(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def confusion(df: DataFrame, actual: str, predicted: str, classes: Sequence[int] = CLASSES) -> DataFrame:
    """Counts for every pair of classes, zeros included."""
    spark = df.sparkSession
    grid = spark.createDataFrame([(a, b) for a in classes for b in classes], "actual int, predicted int")
    counts = df.groupBy(F.col(actual).cast("int").alias("actual"), F.col(predicted).cast("int").alias("predicted")).agg(
        F.count(F.lit(1)).alias("_n"))
    return grid.join(counts, ["actual", "predicted"], "left").select("actual", "predicted", F.coalesce("_n", F.lit(0)).alias("n"))


def class_report(df: DataFrame, actual: str, predicted: str, groups: Sequence[str] = (),
                 classes: Sequence[int] = CLASSES) -> DataFrame:
    """Precision, recall, F1 and support per class (one pass, conditional counts)."""
    y, p = F.col(actual), F.col(predicted)
    counts = []
    for k in classes:
        counts += [F.count(F.when((y == k) & (p == k), 1)).alias(f"tp{k}"), F.count(F.when((y != k) & (p == k), 1)).alias(f"fp{k}"),
                   F.count(F.when((y == k) & (p != k), 1)).alias(f"fn{k}")]
    wide = df.groupBy(*groups).agg(*counts)
    rows = F.array(*[F.struct(F.lit(k).alias("class"), *[F.col(f"{m}{k}").alias(m) for m in ("tp", "fp", "fn")]) for k in classes])
    tp, fp, fn = F.col("r.tp"), F.col("r.fp"), F.col("r.fn")
    return wide.select(*groups, F.explode(rows).alias("r")).select(
        *groups, F.col("r.class").alias("class"), _ratio(tp, tp + fp).alias("precision"), _ratio(tp, tp + fn).alias("recall"),
        _ratio(2 * tp, 2 * tp + fp + fn).alias("f1"), (tp + fn).alias("support"), (tp + fp + fn > 0).alias("seen"), tp.alias("tp"))


def summary(df: DataFrame, actual: str, predicted: str, groups: Sequence[str] = (), fixed_classes: bool = False) -> DataFrame:
    """Accuracy and macro F1 (over classes seen in either column, or over all three)."""
    report = class_report(df, actual, predicted, groups)
    over = F.lit(True) if fixed_classes else F.col("seen")
    return report.groupBy(*groups).agg(
        _ratio(F.sum("tp"), F.sum("support")).alias("accuracy"),
        F.coalesce(F.avg(F.when(over, F.col("f1"))), F.lit(0.0)).alias("macro_f1"), F.sum("support").alias("n"))


def roc_auc(df: DataFrame, label: str, score: str) -> DataFrame:
    """Exact area under the curve, ties counted half; NULL unless both classes occur."""
    rows = totals_below(df, score, {"pos": F.col(label).cast("bigint"), "neg": (1 - F.col(label)).cast("bigint")})
    beaten = F.sum(F.col("pos") * (F.col("neg_below") + F.col("neg") / 2.0))
    return rows.agg(F.try_divide(beaten, F.sum("pos").cast("double") * F.sum("neg")).alias("auc"),
                    F.sum("pos").alias("positives"), F.sum("neg").alias("negatives"))


def average_precision(df: DataFrame, label: str, score: str) -> DataFrame:
    """Sum of recall steps times precision over distinct scores, highest first."""
    rows = totals_below(df, score, {"pos": F.col(label).cast("bigint"), "n": F.lit(1).cast("bigint")})
    whole = df.agg(F.sum(F.col(label).cast("bigint")).alias("_p"), F.count(F.lit(1)).alias("_n"))
    joined = with_scalars(rows, whole)
    precision = F.try_divide((F.col("_p") - F.col("pos_below")).cast("double"), F.col("_n") - F.col("n_below"))
    return joined.agg(F.sum(F.try_divide(F.col("pos").cast("double"), F.col("_p")) * precision).alias("average_precision"))


def majority_baseline(train: DataFrame, evaluated: DataFrame, label: str) -> DataFrame:
    """Score of always predicting the most frequent training class (lowest on ties)."""
    top = train.groupBy(F.col(label).alias("majority")).agg(F.count(F.lit(1)).alias("_n")).orderBy(
        F.col("_n").desc(), "majority").limit(1).select("majority")
    return summary(with_scalars(evaluated, top), label, "majority", ["majority"])


def calibration(df: DataFrame, probability: str, hit: Column, bins: int = 10) -> DataFrame:
    """Mean probability and observed share per probability bin, with the gap and its weight."""
    p = F.col(probability)
    binned = df.groupBy(F.least(F.floor(p * bins), F.lit(bins - 1)).cast("int").alias("bin")).agg(
        F.count(F.lit(1)).alias("n"), F.avg(p).alias("mean_probability"), F.avg(hit.cast("double")).alias("observed"))
    return binned.withColumn("gap", F.abs(F.col("mean_probability") - F.col("observed")))


def calibration_error(table: DataFrame, trigger: float = 0.12) -> DataFrame:
    ece = F.sum(F.col("gap") * F.col("n")) / F.sum("n")
    return table.agg(ece.alias("ece"), (ece > trigger).alias("triggered"))


def expectancy_curve(trades: DataFrame, layout: Layout, window: int = 30, r: str = "rr_realized") -> DataFrame:
    """Cumulative R, its mean over the last ``window`` trades, and whether that is negative."""
    L = layout.reach(before=window)
    df = with_running(to_blocks(trades, L), L, {"cumulative_r": Running("sum", r)})
    df = df.withColumn("rolling_expectancy", Rolling(L, window).mean(r))
    return from_blocks(df).withColumn("triggered", F.coalesce(F.col("rolling_expectancy") < 0, F.lit(False)))
