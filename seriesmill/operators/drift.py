"""Distribution drift between a reference and a current sample."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from seriesmill.functions.scalar import is_finite
from seriesmill.plans import wide
from seriesmill.plans.blocks import POS, TOTAL, Layout, with_positions
from seriesmill.plans.materialize import settle, sized, with_scalars
from seriesmill.plans.quantiles import exact_quantiles

EPSILON, MODERATE, SIGNIFICANT = 1e-6, 0.10, 0.25


def severity(psi: Column) -> Column:
    return F.when(psi < MODERATE, "stable").when(psi < SIGNIFICANT, "moderate").otherwise("significant")


def mark_samples(df: DataFrame, layout: Layout, reference: float = 0.70, current: float = 0.85) -> DataFrame:
    """``sample`` = ref for the first 70 % of a series, cur for the last 15 %, else NULL."""
    bucket = F.floor(F.unix_millis(F.col(layout.ts)) / F.lit(layout.bucket_ms))
    df = with_positions(df, layout.keys, bucket, [layout.ts])
    part = (F.when(F.col(POS) < F.floor(F.col(TOTAL) * F.lit(reference)), "ref")
            .when(F.col(POS) >= F.floor(F.col(TOTAL) * F.lit(current)), "cur"))
    return df.withColumn("sample", part).drop(POS, TOTAL)


def psi_long(long: DataFrame, groups: Sequence[str], bins: int = 10) -> DataFrame:
    """PSI per group of a long frame ``groups..., sample (ref/cur), value``.

    Bin edges are the distinct reference quantiles with open ends; fewer than three edges
    or two values on either side give 0.
    """
    groups = list(groups)
    data = long.where(is_finite(F.col("value")) & F.col("sample").isNotNull())
    quantiles = exact_quantiles(data.where("sample = 'ref'"), groups, "value", [k / bins for k in range(bins + 1)])
    # at most bins + 1 edges per group
    edges = quantiles.groupBy(*groups).agg(F.array_sort(F.collect_set("q")).alias("_e"))
    inner = F.slice("_e", F.lit(2), F.greatest(F.size("_e") - 2, F.lit(0)))
    edges = sized(edges.select(*groups, F.size("_e").alias("_n_edges"), inner.alias("_inner")))
    binned = data.join(edges, groups).withColumn("_bin", F.size(F.filter("_inner", lambda e: e <= F.col("value"))))
    ref, cur = F.col("sample") == "ref", F.col("sample") == "cur"
    counts = binned.groupBy(*groups, "_n_edges", "_bin").agg(F.count(F.when(ref, 1)).alias("_r"), F.count(F.when(cur, 1)).alias("_c"))
    # one map of at most ``bins`` entries per group; absent bins count zero on both sides
    per = counts.groupBy(*groups, "_n_edges").agg(
        F.sum("_r").alias("_nr"), F.sum("_c").alias("_nc"),
        F.map_from_entries(F.collect_list(F.struct("_bin", F.struct("_r", "_c")))).alias("_m"))
    share = lambda x, n: F.greatest(F.coalesce(x, F.lit(0)) / F.greatest(n, F.lit(1)), F.lit(EPSILON))

    def term(k: Column) -> Column:
        at = F.try_element_at(F.col("_m"), k)
        r, c = share(at["_r"], F.col("_nr")), share(at["_c"], F.col("_nc"))
        return (c - r) * F.ln(c / r)

    psi = F.aggregate(F.transform(F.sequence(F.lit(0), F.col("_n_edges") - 2), term), F.lit(0.0), lambda a, x: a + x)
    usable = (F.col("_n_edges") >= 3) & (F.col("_nr") >= 2) & (F.col("_nc") >= 2)
    return per.select(*groups, F.when(usable, psi).otherwise(0.0).alias("psi"))


def drift_table(df: DataFrame, columns: Sequence[str], groups: Sequence[str] = (), bins: int = 10) -> DataFrame:
    """PSI and severity per numeric column (and group); ``df`` carries a ``sample`` column.

    All columns are looked at together: their reference quantiles by radix selection, then one count of both samples
    between the edges.  A column without a finite reference value in a group has no row.
    """
    groups, columns = list(groups), list(columns)
    data = df.where(F.col("sample").isNotNull()).select(
        *groups, "sample", *[F.when(is_finite(F.col(c).cast("double")), F.col(c).cast("double")).alias(c) for c in columns])
    quantiles = wide.quantiles(data.where("sample = 'ref'"), groups, columns, [k / bins for k in range(bins + 1)])
    edges = quantiles.groupBy(*groups, "feature").agg(F.array_sort(F.collect_set("q")).alias("_e"))
    inner = F.slice("_e", F.lit(2), F.greatest(F.size("_e") - 2, F.lit(0)))
    edges = settle(edges.select(*groups, "feature", F.size("_e").alias("_n_edges"), inner.alias("edges")))
    counts = settle(wide.bin_counts(data, groups, columns, edges, {"_r": "sample = 'ref'", "_c": "sample = 'cur'"}))
    at = [*groups, "feature"]
    totals = counts.groupBy(*at).agg(F.sum("_r").alias("_nr"), F.sum("_c").alias("_nc"))
    share = lambda x, n: F.greatest(F.col(x) / F.greatest(F.col(n), F.lit(1)), F.lit(EPSILON))
    known = totals.join(edges.drop("edges"), at)
    r, c = share("_r", "_nr"), share("_c", "_nc")
    psi = F.sum((c - r) * F.ln(c / r))
    usable = (F.col("_n_edges") >= 3) & (F.col("_nr") >= 2) & (F.col("_nc") >= 2)
    found = counts.join(known, at).groupBy(*at, "_n_edges", "_nr", "_nc").agg(psi.alias("_psi"))
    return found.select(*at, F.when(usable, F.col("_psi")).otherwise(0.0).alias("psi")).withColumn("severity", severity(F.col("psi")))


def shift_histogram(long: DataFrame, groups: Sequence[str], bins: int = 30) -> DataFrame:
    """Densities of both samples over equal bins of their joint range."""
    groups = list(groups)
    data = long.where(is_finite(F.col("value")) & F.col("sample").isNotNull())
    ranges = sized(data.groupBy(*groups).agg(F.min("value").alias("_lo"), F.max("value").alias("_hi")))
    width = (F.col("_hi") - F.col("_lo")) / bins
    place = F.least(F.floor(F.try_divide(F.col("value") - F.col("_lo"), width)), F.lit(bins - 1))
    counts = data.join(ranges, groups).groupBy(*groups, "sample", "_lo", "_hi", F.coalesce(place, F.lit(0)).cast("int").alias("bin")).agg(
        F.count(F.lit(1)).alias("n"))
    totals = counts.groupBy(*groups, "sample").agg(F.sum("n").alias("_total"))
    return counts.join(totals, [*groups, "sample"]).select(
        *groups, "sample", "bin", "n", (F.col("_lo") + F.col("bin") * width).alias("bin_start"),
        F.try_divide(F.col("n").cast("double"), F.col("_total") * width).alias("density"))


def class_shares(df: DataFrame, column: str, groups: Sequence[str] = ()) -> DataFrame:
    """Share of every class in the reference and the current sample."""
    counts = df.where(F.col("sample").isNotNull()).groupBy(*groups, F.col(column)).agg(
        F.count(F.when(F.col("sample") == "ref", 1)).alias("_r"), F.count(F.when(F.col("sample") == "cur", 1)).alias("_c"))
    totals = counts.groupBy(*groups).agg(F.sum("_r").alias("_nr"), F.sum("_c").alias("_nc"))
    joined = counts.join(totals, list(groups)) if groups else with_scalars(counts, totals)
    return joined.select(*groups, column, F.try_divide(F.col("_r").cast("double"), F.col("_nr")).alias("reference_share"),
                         F.try_divide(F.col("_c").cast("double"), F.col("_nc")).alias("current_share"))


def retrain_check(drift: DataFrame, row_counts: DataFrame, groups: Sequence[str], min_rows: int = 200) -> DataFrame:
    """Per series: significant drifts, the strongest one, rows against the retrain threshold.

    ``row_counts`` carries ``rows`` and ``retrain_bar_threshold``.  A series with less than ``min_rows``
    keeps its row, with status ``too_few_rows`` and no verdict on its drift.
    """
    groups = list(groups)
    significant = F.col("severity") == "significant"
    per = drift.groupBy(*groups).agg(
        F.count(F.when(significant, 1)).alias("significant_features"),
        F.max_by("feature", F.struct("psi", "feature")).alias("top_feature"), F.max("psi").alias("top_psi"))
    enough = F.col("rows") >= min_rows
    found = row_counts.join(per, groups, "left").withColumns({
        c: F.when(enough, F.col(c)) for c in ("significant_features", "top_feature", "top_psi")})
    return found.withColumns({
        "status": F.when(enough, "checked").otherwise("too_few_rows"),
        "retrain_recommended": F.col("significant_features") > 0,
        "enough_new_bars": F.col("rows") >= F.col("retrain_bar_threshold")})


class DriftState:
    """Drift of new bars against a reference without reading old bars again.

    The state is a table of histograms per series, period and column on the leading bits of the values
    (64 steps per power of two).  They add up: a new period is counted once and stored beside the others, a period
    that is delivered again replaces itself, and a check adds the periods it needs.  Bin edges lie on the steps, so
    PSI differs a little from ``drift_table``, but not between a state built at once and one built bit by bit.
    """

    def __init__(self, spark: SparkSession, path: str, columns: Sequence[str], groups: Sequence[str]):
        self.spark, self.path, self.columns, self.groups = spark, path, list(columns), list(groups)

    def add(self, bars: DataFrame, period: Column) -> None:
        """Count the rows of ``bars``, whole periods of them, and store what they add."""
        named = bars.withColumn("period", period)
        wide.histograms(named, [*self.groups, "period"], self.columns).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic").partitionBy("period").parquet(self.path)

    def check(self, reference: Column, current: Column, bins: int = 10) -> DataFrame:
        """``groups..., feature, psi, severity`` of the periods that satisfy ``reference`` and ``current``."""
        at = [*self.groups, "feature"]
        stored = self.spark.read.parquet(self.path).where(reference | current)
        steps = stored.groupBy(*at, "digit").agg(F.sum(F.when(reference, F.col("n")).otherwise(0)).alias("_r"),
                                                 F.sum(F.when(current, F.col("n")).otherwise(0)).alias("_c"))
        per, upto = Window.partitionBy(*at), Window.partitionBy(*at).orderBy("digit").rowsBetween(Window.unboundedPreceding, 0)
        placed = steps.withColumns({"_nr": F.sum("_r").over(per), "_nc": F.sum("_c").over(per), "_upto": F.sum("_r").over(upto)})
        ranks = F.array(*[F.floor(F.lit(k / bins) * (F.col("_nr") - 1)) for k in range(bins + 1)])
        # a step is an edge if a wanted rank of the reference lies in it
        edge = (F.col("_r") > 0) & F.exists(ranks, lambda r: (r < F.col("_upto")) & (r >= F.col("_upto") - F.col("_r")))
        marked = placed.withColumn("_edge", edge.cast("int")).withColumns({
            "_edges": F.sum("_edge").over(per), "_number": F.sum("_edge").over(upto)})
        # the first edge opens the first bin and the last one the last: both ends are open
        place = F.least(F.greatest(F.col("_number") - 1, F.lit(0)), F.greatest(F.col("_edges") - 2, F.lit(0)))
        cells = marked.groupBy(*at, "_edges", "_nr", "_nc", place.alias("_bin")).agg(F.sum("_r").alias("_r"), F.sum("_c").alias("_c"))
        share = lambda x, n: F.greatest(F.col(x) / F.greatest(F.col(n), F.lit(1)), F.lit(EPSILON))
        r, c = share("_r", "_nr"), share("_c", "_nc")
        found = cells.groupBy(*at, "_edges", "_nr", "_nc").agg(F.sum((c - r) * F.ln(c / r)).alias("_psi"))
        usable = (F.col("_edges") >= 3) & (F.col("_nr") >= 2) & (F.col("_nc") >= 2)
        return found.where("_nr > 0").select(*at, F.when(usable, F.col("_psi")).otherwise(0.0).alias("psi")).withColumn("severity", severity(F.col("psi")))
