"""Feature selection X1-X6 and models M1-M2."""

from __future__ import annotations

from pyspark.sql import functions as F

from seriesmill.catalog.base import fragment, query, r6, shared, sql
from seriesmill.catalog.dataset import CONTEXT, INPUTS, KEYS, LENGTH, SEQUENCE, matrix, ms, scaled_samples, split_rows
from seriesmill.catalog.features import HOURLY
from seriesmill.functions.scalar import rnd
from seriesmill.operators import models, rows, selection as sel
from seriesmill.operators.matrix import feature_columns
from seriesmill.plans.gram import correlations

fragment("fx", ("fm",), "fx AS MATERIALIZED (SELECT symbol, i, ts_ms, " + ", ".join(INPUTS) + " FROM fm)")


def _each(expr: str, alias: str, source: str = "fx") -> str:
    return " UNION ALL ".join(f"SELECT '{c}' AS feature, {expr.format(c=c)} AS {alias} FROM {source}" for c in INPUTS)


@query("x1_null_ratio", sql(["fx"], f"SELECT feature, {r6('ratio', 'ratio')}, ratio >= 0.85 AS kept FROM ({_each('avg(({c} IS NOT NULL)::INT)', 'ratio')})"))
def x1(spark, sf_dir):
    return sel.null_ratios(matrix(spark, sf_dir), INPUTS).select("feature", rnd("ratio").alias("ratio"), "kept")


@query("x2_low_variance", sql(["fx"], f"SELECT feature, {r6('variance', 'variance')}, coalesce(variance > 1e-6, FALSE) AS kept FROM ({_each('var_pop({c})', 'variance')})"))
def x2(spark, sf_dir):
    return sel.variances(matrix(spark, sf_dir), INPUTS).select("feature", rnd("variance").alias("variance"), "kept")


fragment("xl", ("fx",), "xl AS MATERIALIZED (" + " UNION ALL ".join(
    f"SELECT symbol, i, {k} AS k, '{c}' AS f, {c} AS v FROM fx WHERE {c} IS NOT NULL" for k, c in enumerate(INPUTS)) + ")")
# a column without variance over the shared rows has no correlation
fragment("xc", ("xl",), """
xc AS MATERIALIZED (SELECT a, b, ka, kb, CASE WHEN isfinite(r) THEN r END AS r FROM (
  SELECT x.f AS a, y.f AS b, x.k AS ka, y.k AS kb, CASE WHEN min(x.v) < max(x.v) AND min(y.v) < max(y.v) THEN corr(x.v, y.v) END AS r
  FROM xl x JOIN xl y ON x.symbol = y.symbol AND x.i = y.i AND x.k < y.k GROUP BY ALL))""")


fragment("xn", (), "xn AS (SELECT f, k FROM (VALUES " + ", ".join(f"('{c}', {k})" for k, c in enumerate(INPUTS)) + ") v(f, k))")


@query("x3_correlation_matrix", sql(["xc", "xn"], f"""
SELECT x.f AS a, y.f AS b, {r6('r', 'r')} FROM xn x JOIN xn y ON x.k < y.k LEFT JOIN xc ON xc.ka = x.k AND xc.kb = y.k"""))
def x3(spark, sf_dir):
    return correlations(matrix(spark, sf_dir), INPUTS).select("a", "b", rnd("r").alias("r"))


@query("x3_correlation_drops")
def x3_drops(spark, sf_dir):
    """Greedy drops over all matrix columns."""
    m = matrix(spark, sf_dir)
    dropped = sel.correlated_drops(correlations(m, feature_columns(m)), always_keep=sel.ALWAYS_KEEP)
    return spark.createDataFrame(dropped, "dropped string, first string, second string")


fragment("mil", ("fx", "tb"), "mil AS MATERIALIZED (SELECT feature, y, round(v, 9) AS v FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, (direction = 2)::INT AS y, coalesce(fx.{c}, 0) AS v FROM fx JOIN (SELECT symbol, i, direction FROM tb WHERE direction IN (0, 2)) t USING (symbol, i)"
    for c in INPUTS) + "))")
_cuts = ", ".join(f"quantile_cont(v, {k / 10})" for k in range(1, 10))


@query("x4_mutual_information", sql(["mil"], f"""
, me AS (SELECT feature, list_sort(list_distinct([{_cuts}])) AS e FROM mil GROUP BY 1),
mc AS (SELECT feature, bin, y, count(*) AS n FROM (SELECT feature, y, len(list_filter(e, lambda z: z <= v)) AS bin FROM mil JOIN me USING (feature)) GROUP BY 1, 2, 3)
SELECT feature, {r6('greatest(sum(n::DOUBLE / t * ln(n::DOUBLE * t / (nb * ny))), 0)', 'score')}
FROM (SELECT *, sum(n) OVER (PARTITION BY feature) AS t, sum(n) OVER (PARTITION BY feature, bin) AS nb, sum(n) OVER (PARTITION BY feature, y) AS ny FROM mc) GROUP BY 1""").replace("\n, me", ", me"))
def x4(spark, sf_dir):
    from seriesmill.catalog.dataset import labels
    target = rows.binary_target(labels(spark, sf_dir)).select(*KEYS, "ts", "y")
    data = matrix(spark, sf_dir).select(*KEYS, "ts", *[F.round(c, 9).alias(c) for c in INPUTS]).join(target, [*KEYS, "ts"])
    return sel.mutual_information(data, INPUTS, "y").select("feature", rnd("score").alias("score"))


def _parts(spark, sf_dir):
    """Training and validation rows of the binary target, with every matrix column."""
    def build(s, d):
        split = rows.binary_target(split_rows(s, d)).select(*KEYS, "ts", "split", "y")
        return matrix(s, d).join(split, [*KEYS, "ts"])
    df = shared(spark, sf_dir, "selection_rows", build)
    return df.where("split = 'train'"), df.where("split = 'val'")


@query("x5_permutation_importance")
def x5(spark, sf_dir):
    _, val = _parts(spark, sf_dir)
    return sel.permutation_importance(val, INPUTS, "y", ["symbol", "ts"])


@query("x6_select_features")
def x6(spark, sf_dir):
    train, val = _parts(spark, sf_dir)
    columns = [c for c in feature_columns(train) if c != "y"]
    return sel.select_features(train, val, columns, "y", ["symbol", "ts"])


def _scored(spark, sf_dir):
    def build(s, d):
        rows_ = scaled_samples(s, d)
        return models.score(rows_, HOURLY, models.train_heads(rows_, HOURLY, SEQUENCE, CONTEXT, LENGTH))
    return shared(spark, sf_dir, "scored", build)


@query("m1_train_heads")
def m1(spark, sf_dir):
    """Accuracy of the four heads per split."""
    df = _scored(spark, sf_dir)
    from seriesmill.operators.signals import top_class
    hit = lambda a, b: F.avg((a == F.col(b)).cast("double"))
    return df.groupBy("split").agg(
        F.count(F.lit(1)).alias("samples"), hit(top_class(), "y_direction").alias("direction_accuracy"),
        hit(F.col("regime_id"), "y_regime").alias("regime_accuracy"), hit(F.col("cycle_id"), "y_cycle").alias("cycle_accuracy"),
        hit((F.col("quality") >= 0.5).cast("int"), "y_trade_quality").alias("quality_accuracy"))


@query("m2_batch_scoring")
def m2(spark, sf_dir):
    return _scored(spark, sf_dir).select("symbol", ms(), "split", *[rnd(c).alias(c) for c in ("p_down", "p_sideways", "p_up", "quality")],
                                         "regime_id", "cycle_id")


@query("m2_latest_prediction")
def m2_latest(spark, sf_dir):
    df = models.latest_predictions(_scored(spark, sf_dir), KEYS)
    return df.select("symbol", ms(), *[rnd(c).alias(c) for c in ("p_down", "p_sideways", "p_up", "quality")])
