"""Evaluation, drift and monitoring E1-E19 and join J9."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from seriesmill.catalog.base import fragment, query, r6, sql, uniform_sql
from seriesmill.catalog.dataset import INPUTS, KEYS, labels, matrix, ms
from seriesmill.catalog.features import HOURLY
from seriesmill.catalog.trading import CURVE, PROFIT_FACTOR, metrics, trades
from seriesmill.functions.scalar import rnd, to_ms
from seriesmill.keys import RETRAIN_MIN_BARS
from seriesmill.operators import drift, evaluate as ev, monitor, outcomes as out, signals as sig
from seriesmill.plans.materialize import with_scalars
from seriesmill.session import ensure_checkpoint_dir
from seriesmill.sources import given
from seriesmill.sources.ticks import bars


def classified(spark, sf_dir):
    return given.predictions(spark, sf_dir).withColumn("predicted", sig.top_class())


@query("e1_confusion_matrix", sql(["predc"], """
SELECT CAST(a AS BIGINT) AS actual, CAST(p AS BIGINT) AS predicted, CAST(count(event_id) AS BIGINT) AS n
FROM range(3) x(a) CROSS JOIN range(3) z(p) LEFT JOIN predc ON y = a AND c = p GROUP BY 1, 2"""))
def e1(spark, sf_dir):
    m = ev.confusion(classified(spark, sf_dir), "y", "predicted")
    return m.select(*[F.col(c).cast("bigint").alias(c) for c in m.columns])


fragment("rep", ("predc",), """
rep AS MATERIALIZED (
  SELECT k, tp, fp, fn, coalesce(tp::DOUBLE / nullif(tp + fp, 0), 0) AS precision, coalesce(tp::DOUBLE / nullif(tp + fn, 0), 0) AS recall,
         coalesce(2.0::DOUBLE * tp / nullif(2 * tp + fp + fn, 0), 0) AS f1
  FROM (SELECT k, count(*) FILTER (y = k AND c = k) AS tp, count(*) FILTER (y <> k AND c = k) AS fp, count(*) FILTER (y = k AND c <> k) AS fn
        FROM range(3) r(k), predc GROUP BY 1))""")


@query("e2_class_report", sql(["rep"], f"""
SELECT CAST(k AS BIGINT) AS class, {r6('precision', 'precision')}, {r6('recall', 'recall')}, {r6('f1', 'f1')}, CAST(tp + fn AS BIGINT) AS support FROM rep"""))
def e2(spark, sf_dir):
    r = ev.class_report(classified(spark, sf_dir), "y", "predicted")
    return r.select(F.col("class").cast("bigint").alias("class"), *[rnd(c).alias(c) for c in ("precision", "recall", "f1")], "support")


@query("e2_accuracy_macro_f1", sql(["rep"], f"""
SELECT {r6('sum(tp)::DOUBLE / sum(tp + fn)', 'accuracy')}, {r6('avg(f1) FILTER (tp + fp + fn > 0)', 'macro_f1')}, CAST(sum(tp + fn) AS BIGINT) AS n FROM rep"""))
def e2_summary(spark, sf_dir):
    s = ev.summary(classified(spark, sf_dir), "y", "predicted")
    return s.select(rnd("accuracy").alias("accuracy"), rnd("macro_f1").alias("macro_f1"), "n")


def scored_documents(spark, sf_dir):
    """Labelled documents: quality as label, length as score (with ties)."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "n_chars")
    marks = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    return docs.join(marks, "doc_id").select(F.col("quality").cast("bigint").alias("label"), F.col("n_chars").cast("double").alias("score"))


_sc = "sc AS MATERIALIZED (SELECT quality AS label, n_chars AS score FROM documents JOIN labels USING (doc_id))"
fragment("sc", (), _sc)


@query("e3_roc_auc", sql(["sc"], f"""
SELECT {r6('sum((neg_below + neg / 2.0) * pos) / (sum(pos)::DOUBLE * sum(neg))', 'auc')}, CAST(sum(pos) AS BIGINT) AS positives, CAST(sum(neg) AS BIGINT) AS negatives
FROM (SELECT *, coalesce(sum(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS neg_below
      FROM (SELECT score, sum(label) AS pos, sum(1 - label) AS neg FROM sc GROUP BY 1))"""))
def e3(spark, sf_dir):
    a = ev.roc_auc(scored_documents(spark, sf_dir), "label", "score")
    return a.select(rnd("auc").alias("auc"), "positives", "negatives")


@query("e4_average_precision", sql(["sc"], f"""
SELECT {r6('sum(pos::DOUBLE / p * tp / n)', 'average_precision')}
FROM (SELECT *, sum(pos) OVER (ORDER BY score DESC) AS tp, sum(m) OVER (ORDER BY score DESC) AS n, sum(pos) OVER () AS p
      FROM (SELECT score, sum(label) AS pos, count(*) AS m FROM sc GROUP BY 1))"""))
def e4(spark, sf_dir):
    return ev.average_precision(scored_documents(spark, sf_dir), "label", "score").select(rnd("average_precision").alias("average_precision"))


_base = """
maj AS MATERIALIZED (SELECT y AS majority FROM pred WHERE day(ts) <= 21 GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1),
evl AS MATERIALIZED (SELECT pred.*, majority FROM pred, maj WHERE day(ts) > 21),
mj AS MATERIALIZED (SELECT any_value(majority) AS majority, count(*) FILTER (y = majority)::DOUBLE / count(*) AS accuracy,
  2.0::DOUBLE * count(*) FILTER (y = majority) / (count(*) + count(*) FILTER (y = majority)) / count(DISTINCT y) AS macro_f1, count(*) AS n FROM evl)"""
fragment("mj", ("pred",), _base)


def _train_eval(spark, sf_dir):
    """The first three weeks of the month to fit on, the rest to evaluate."""
    df = classified(spark, sf_dir)
    return df.where(F.dayofmonth("ts") <= 21), df.where(F.dayofmonth("ts") > 21)


@query("e5_majority_baseline", sql(["mj"], f"SELECT CAST(majority AS BIGINT) AS majority, {r6('accuracy', 'accuracy')}, {r6('macro_f1', 'macro_f1')}, CAST(n AS BIGINT) AS n FROM mj"))
def e5(spark, sf_dir):
    train, evaluated = _train_eval(spark, sf_dir)
    b = ev.majority_baseline(train, evaluated, "y")
    return b.select(F.col("majority").cast("bigint").alias("majority"), rnd("accuracy").alias("accuracy"), rnd("macro_f1").alias("macro_f1"), "n")


@query("e5_random_baseline", sql(["pred"], f"""
, g AS MATERIALIZED (SELECT y, CAST(floor({uniform_sql("event_id")} * 3) AS INTEGER) AS c FROM pred)
SELECT {r6('a.accuracy', 'accuracy')}, {r6('f.f1', 'macro_f1')}, CAST(a.n AS BIGINT) AS n
FROM (SELECT count(*) FILTER (y = c)::DOUBLE / count(*) AS accuracy, count(*) AS n FROM g) a,
     (SELECT avg(f1) FILTER (s > 0) AS f1 FROM (SELECT k, tp + fp + fn AS s, coalesce(2.0::DOUBLE * tp / nullif(2 * tp + fp + fn, 0), 0) AS f1
        FROM (SELECT k, count(*) FILTER (y = k AND c = k) AS tp, count(*) FILTER (y <> k AND c = k) AS fp, count(*) FILTER (y = k AND c <> k) AS fn
              FROM range(3) r(k), g GROUP BY 1))) f""").replace("\n, g AS", ", g AS"))
def e5_random(spark, sf_dir):
    df = classified(spark, sf_dir).withColumn("guess", F.floor(sig.random_choice("event_id") * 3).cast("int"))
    s = ev.summary(df, "y", "guess")
    return s.select(rnd("accuracy").alias("accuracy"), rnd("macro_f1").alias("macro_f1"), "n")


@query("e6_beats_baseline", sql(["mj", "predc"], f"""
SELECT {r6('m.f1', 'model_macro_f1')}, {r6('mj.macro_f1', 'baseline_macro_f1')}, m.f1 > mj.macro_f1 AS beats_majority
FROM mj, (SELECT avg(f1) FILTER (s > 0) AS f1 FROM (SELECT k, tp + fp + fn AS s, coalesce(2.0::DOUBLE * tp / nullif(2 * tp + fp + fn, 0), 0) AS f1
  FROM (SELECT k, count(*) FILTER (y = k AND c = k) AS tp, count(*) FILTER (y <> k AND c = k) AS fp, count(*) FILTER (y = k AND c <> k) AS fn
        FROM range(3) r(k), predc WHERE day(ts) > 21 GROUP BY 1))) m"""))
def e6(spark, sf_dir):
    train, evaluated = _train_eval(spark, sf_dir)
    model = ev.summary(evaluated, "y", "predicted").select(F.col("macro_f1").alias("_m"))
    base = ev.majority_baseline(train, evaluated, "y").select(F.col("macro_f1").alias("_b"))
    both = with_scalars(model, base)
    return both.select(rnd("_m").alias("model_macro_f1"), rnd("_b").alias("baseline_macro_f1"), (F.col("_m") > F.col("_b")).alias("beats_majority"))


# --- drift --------------------------------------------------------------------------

def psi_sql(source: str, groups: str) -> str:
    """CTEs giving ``psi_out(groups, psi)`` from ``source(groups, sample, v)``."""
    g = groups
    q = ", ".join(f"quantile_cont(v, {k / 10})" for k in range(11))
    return f"""
pe AS MATERIALIZED (SELECT {g}, list_sort(list_distinct([{q}])) AS e FROM {source} WHERE sample = 'ref' AND isfinite(v) GROUP BY {g}),
pb AS MATERIALIZED (SELECT {g}, sample, len(e) AS ne, len(list_filter(e[2:len(e) - 1], lambda z: z <= v)) AS bin FROM {source} JOIN pe USING ({g}) WHERE isfinite(v) AND sample IS NOT NULL),
pn AS MATERIALIZED (SELECT {g}, any_value(ne) AS ne, count(*) FILTER (sample = 'ref') AS nr, count(*) FILTER (sample = 'cur') AS nc FROM pb GROUP BY {g}),
pc AS MATERIALIZED (SELECT {g}, bin, greatest(count(*) FILTER (sample = 'ref')::DOUBLE / greatest(any_value(nr), 1), 1e-6) AS r,
        greatest(count(*) FILTER (sample = 'cur')::DOUBLE / greatest(any_value(nc), 1), 1e-6) AS c FROM pb JOIN pn USING ({g}) GROUP BY {g}, bin),
psi_out AS MATERIALIZED (SELECT {g}, CASE WHEN any_value(ne) < 3 OR any_value(nr) < 2 OR any_value(nc) < 2 THEN 0 ELSE sum((c - r) * ln(c / r)) END AS psi
        FROM pc JOIN pn USING ({g}) GROUP BY {g})"""


_sev = "CASE WHEN psi < 0.10 THEN 'stable' WHEN psi < 0.25 THEN 'moderate' ELSE 'significant' END"
_sample = "CASE WHEN i < floor(n * 0.7::DOUBLE) THEN 'ref' WHEN i >= floor(n * 0.85::DOUBLE) THEN 'cur' END"
fragment("dl", ("fm",), "dl AS MATERIALIZED (" + " UNION ALL ".join(
    f"SELECT symbol, '{c}' AS feature, {_sample} AS sample, round({c}, 9) AS v FROM fm" for c in INPUTS) + ")")
fragment("dpsi", ("dl",), psi_sql("dl", "symbol, feature"))


def sampled(spark, sf_dir):
    # nine decimals: equal values must stay equal whatever order they were summed in
    m = matrix(spark, sf_dir).select(*KEYS, "ts", *[F.round(c, 9).alias(c) for c in INPUTS])
    return drift.mark_samples(m, HOURLY)


@query("e7_psi", sql(["b"], f"""
, dv AS MATERIALIZED (SELECT symbol, {_sample} AS sample, close AS v FROM b), {psi_sql('dv', 'symbol')}
SELECT symbol, {r6('psi', 'psi')} FROM psi_out""").replace("\n, dv", ", dv"))
def e7(spark, sf_dir):
    marked = drift.mark_samples(bars(spark, sf_dir), HOURLY).withColumn("value", F.col("close"))
    return drift.psi_long(marked, ["symbol"]).select("symbol", rnd("psi").alias("psi"))


def drift_by_series(spark, sf_dir):
    from seriesmill.catalog.base import shared
    return shared(spark, sf_dir, "drift", lambda s, d: drift.drift_table(sampled(s, d), INPUTS, KEYS))


@query("e8_severity", sql(["dpsi"], f"SELECT {_sev} AS severity, CAST(count(*) AS BIGINT) AS features FROM psi_out GROUP BY 1"))
def e8(spark, sf_dir):
    return drift_by_series(spark, sf_dir).groupBy("severity").agg(F.count(F.lit(1)).alias("features"))


@query("e9_feature_drift", sql(["dpsi"], f"SELECT symbol, feature, {r6('psi', 'psi')}, {_sev} AS severity FROM psi_out"))
def e9(spark, sf_dir):
    return drift_by_series(spark, sf_dir).select("symbol", "feature", rnd("psi").alias("psi"), "severity").orderBy(F.col("psi").desc())


fragment("pp", ("pred",), "pp AS MATERIALIZED (" + " UNION ALL ".join(
    f"SELECT 'pred_{c}' AS feature, CASE WHEN event_id < 0.7 * m THEN 'ref' WHEN event_id >= 0.85 * m THEN 'cur' END AS sample, p_{c} AS v "
    "FROM pred, (SELECT max(event_id) AS m FROM pred)" for c in ("down", "sideways", "up")) + ")")
fragment("ppsi", ("pp",), psi_sql("pp", "feature"))


@query("e10_prediction_drift", sql(["ppsi"], f"SELECT feature, {r6('psi', 'psi')}, {_sev} AS severity FROM psi_out"))
def e10(spark, sf_dir):
    df = given.predictions(spark, sf_dir)
    top = df.agg(F.max("event_id").alias("_m"))
    k = F.col("event_id")
    marked = with_scalars(df, top).withColumn(
        "sample", F.when(k < 0.7 * F.col("_m"), "ref").when(k >= 0.85 * F.col("_m"), "cur"))
    named = marked.select("sample", *[F.col(f"p_{c}").alias(f"pred_{c}") for c in ("down", "sideways", "up")])
    t = drift.drift_table(named, ["pred_down", "pred_sideways", "pred_up"])
    return t.select("feature", rnd("psi").alias("psi"), "severity")


@query("e11_reference_current_split", sql(["b"], f"SELECT symbol, ts_ms, {_sample} AS sample FROM b"))
def e11(spark, sf_dir):
    return drift.mark_samples(bars(spark, sf_dir), HOURLY).select("symbol", ms(), "sample")


@query("e12_shift_histogram", sql(["b"], f"""
, dv AS MATERIALIZED (SELECT * FROM (SELECT symbol, {_sample} AS sample, close AS v FROM b) WHERE sample IS NOT NULL),
rg AS (SELECT symbol, min(v) AS lo, max(v) AS hi FROM dv GROUP BY 1),
hb AS (SELECT symbol, sample, lo, (hi - lo) / 30 AS w, least(floor((v - lo) / ((hi - lo) / 30)), 29) AS bin, count(*) AS n FROM dv JOIN rg USING (symbol) GROUP BY ALL)
SELECT symbol, sample, CAST(bin AS BIGINT) AS bin, CAST(n AS BIGINT) AS n, {r6('lo + bin * w', 'bin_start')}, {r6('n / (sum(n) OVER (PARTITION BY symbol, sample) * w)', 'density')} FROM hb""").replace("\n, dv", ", dv"))
def e12(spark, sf_dir):
    marked = drift.mark_samples(bars(spark, sf_dir), HOURLY).withColumn("value", F.col("close"))
    h = drift.shift_histogram(marked, ["symbol"])
    return h.select("symbol", "sample", F.col("bin").cast("bigint").alias("bin"), "n", rnd("bin_start").alias("bin_start"), rnd("density").alias("density"))


@query("e13_class_share_drift", sql(["regime", "b"], f"""
SELECT symbol, regime, {r6('r / nullif(sum(r) OVER (PARTITION BY symbol), 0)', 'reference_share')}, {r6('c / nullif(sum(c) OVER (PARTITION BY symbol), 0)', 'current_share')}
FROM (SELECT symbol, regime, count(*) FILTER (sample = 'ref') AS r, count(*) FILTER (sample = 'cur') AS c
      FROM (SELECT symbol, i, {_sample} AS sample FROM b) JOIN (SELECT symbol, i, regime FROM regime) USING (symbol, i) WHERE sample IS NOT NULL GROUP BY 1, 2)"""))
def e13(spark, sf_dir):
    marked = drift.mark_samples(labels(spark, sf_dir), HOURLY)
    s = drift.class_shares(marked, "regime", ["symbol"])
    return s.select("symbol", "regime", rnd("reference_share").alias("reference_share"), rnd("current_share").alias("current_share"))


fragment("cal", ("pred",), """
cal AS MATERIALIZED (SELECT least(floor(p_up * 10), 9) AS bin, count(*) AS n, avg(p_up) AS mp, avg((y = 2)::INT) AS ob FROM pred GROUP BY 1)""")


@query("e14_calibration", sql(["cal"], f"SELECT CAST(bin AS BIGINT) AS bin, CAST(n AS BIGINT) AS n, {r6('mp', 'mean_probability')}, {r6('ob', 'observed')}, {r6('abs(mp - ob)', 'gap')} FROM cal"))
def e14(spark, sf_dir):
    c = ev.calibration(given.predictions(spark, sf_dir), "p_up", F.col("y") == 2)
    return c.select(F.col("bin").cast("bigint").alias("bin"), "n", *[rnd(x).alias(x) for x in ("mean_probability", "observed", "gap")])


@query("e14_calibration_error", sql(["cal"], f"SELECT {r6('sum(abs(mp - ob) * n) / sum(n)', 'ece')}, sum(abs(mp - ob) * n) / sum(n) > 0.12 AS triggered FROM cal"))
def e14_ece(spark, sf_dir):
    c = ev.calibration(given.predictions(spark, sf_dir), "p_up", F.col("y") == 2)
    return ev.calibration_error(c).select(rnd("ece").alias("ece"), "triggered")


@query("e15_expectancy_curve", sql(["eq"], f"""
SELECT strategy, symbol, close_ms, {r6('cr', 'cumulative_r')}, {r6('re', 'rolling_expectancy')}, coalesce(re < 0, FALSE) AS triggered
FROM (SELECT *, sum(rr) OVER (PARTITION BY strategy, symbol ORDER BY k) AS cr,
             CASE WHEN k >= 30 THEN avg(rr) OVER (PARTITION BY strategy, symbol ORDER BY k ROWS BETWEEN 29 PRECEDING AND CURRENT ROW) END AS re FROM eq)"""))
def e15(spark, sf_dir):
    e = ev.expectancy_curve(trades(spark, sf_dir), CURVE)
    return e.select("strategy", "symbol", to_ms(F.col("close_ts")).alias("close_ms"), rnd("cumulative_r").alias("cumulative_r"),
                    rnd("rolling_expectancy").alias("rolling_expectancy"), "triggered")


@query("e16_retrain_check", sql(["dpsi", "b"], f"""
SELECT symbol, CAST(n AS BIGINT) AS rows, CAST(500 AS BIGINT) AS retrain_bar_threshold, CASE WHEN n >= 200 THEN CAST(sig AS BIGINT) END AS significant_features,
       CASE WHEN n >= 200 THEN top_feature END AS top_feature, CASE WHEN n >= 200 THEN {r6('top')} END AS top_psi,
       CASE WHEN n >= 200 THEN sig > 0 END AS retrain_recommended, n >= 500 AS enough_new_bars, CASE WHEN n >= 200 THEN 'checked' ELSE 'too_few_rows' END AS status
FROM (SELECT symbol, count(*) AS n FROM b GROUP BY 1)
LEFT JOIN (SELECT symbol, count(*) FILTER (psi >= 0.25) AS sig, arg_max(feature, psi) AS top_feature, max(psi) AS top FROM psi_out GROUP BY 1) USING (symbol)"""))
def e16(spark, sf_dir):
    """Every series, short ones included."""
    counts = bars(spark, sf_dir).groupBy(*KEYS).agg(F.count(F.lit(1)).alias("rows")).withColumn(
        "retrain_bar_threshold", F.lit(RETRAIN_MIN_BARS["1h"]).cast("bigint"))
    r = drift.retrain_check(drift_by_series(spark, sf_dir), counts, KEYS)
    return r.select("symbol", "rows", "retrain_bar_threshold", "significant_features", "top_feature", rnd("top_psi").alias("top_psi"),
                    "retrain_recommended", "enough_new_bars", "status")


@query("e16_running_check")
def e16_running(spark, sf_dir):
    """A drift check that gets the bars week by week: each week is counted once, the last one is held against the others."""
    m = matrix(spark, sf_dir)
    week = F.floor(F.unix_seconds("ts") / F.lit(7 * 86_400)).cast("int")
    weeks = sorted(r["w"] for r in m.select(week.alias("w")).distinct().collect())
    state = drift.DriftState(spark, f"{ensure_checkpoint_dir(spark)}/drift-{uuid.uuid4().hex}", INPUTS, ["symbol"])
    for w in weeks:
        state.add(m.where(week == w), week)
    found = state.check(F.col("period") < weeks[-1], F.col("period") == weeks[-1])
    return found.select("symbol", "feature", rnd("psi").alias("psi"), "severity")



# --- shadow and promotion -----------------------------------------------------------

fragment("shadow", (), """
shadow AS MATERIALIZED (
  SELECT *, CASE WHEN top < 0.58::DOUBLE THEN 'no_trade' WHEN pu >= 0.58::DOUBLE AND q >= 0.6::DOUBLE THEN 'long_bias' WHEN pd >= 0.58::DOUBLE AND q >= 0.6::DOUBLE THEN 'short_bias' ELSE 'no_trade' END AS ps,
         CASE WHEN ctop < 0.58::DOUBLE THEN 'no_trade' WHEN cu >= 0.58::DOUBLE AND cq >= 0.6::DOUBLE THEN 'long_bias' WHEN cd >= 0.58::DOUBLE AND cq >= 0.6::DOUBLE THEN 'short_bias' ELSE 'no_trade' END AS cs
  FROM (SELECT event_id, d / t AS pd, s / t AS psd, u / t AS pu, q, greatest(d / t, s / t, u / t) AS top, d2 / t2 AS cd, u2 / t2 AS cu, q2 AS cq, greatest(d2 / t2, s2 / t2, u2 / t2) AS ctop
    FROM (SELECT *, CAST(d + s + u AS DOUBLE) AS t, CAST(d2 + s2 + u2 AS DOUBLE) AS t2 FROM (
      SELECT event_id, (event_id * 7919) % 1000 + 1 AS d, (event_id * 104729) % 1000 + 1 AS s, (event_id * 611953) % 1000 + 1 AS u, ((event_id * 31) % 1000) / 1000.0::DOUBLE AS q,
             ((event_id + 17) * 7919) % 1000 + 1 AS d2, ((event_id + 17) * 104729) % 1000 + 1 AS s2, ((event_id + 17) * 611953) % 1000 + 1 AS u2, (((event_id + 17) * 31) % 1000) / 1000.0::DOUBLE AS q2
      FROM events))))""")


def shadow(spark, sf_dir):
    return monitor.shadow_log(given.predictions(spark, sf_dir), given.predictions(spark, sf_dir, 17), ["event_id"])


@query("j9_production_join_candidate", sql(["shadow"], f"SELECT event_id, ps AS production_signal, cs AS candidate_signal, {r6('q', 'production_trade_quality')}, {r6('cq', 'candidate_trade_quality')} FROM shadow"))
def j9(spark, sf_dir):
    return shadow(spark, sf_dir).select("event_id", "production_signal", "candidate_signal", rnd("production_trade_quality").alias("production_trade_quality"),
                                        rnd("candidate_trade_quality").alias("candidate_trade_quality"))


_counts = ", ".join(f"CAST(count(*) FILTER ({c}s = '{s}') AS BIGINT) AS {w}_{s}" for c, w in (("p", "production"), ("c", "candidate"))
                    for s in ("long_bias", "short_bias", "no_trade"))


@query("e17_shadow_summary", sql(["shadow"], f"SELECT CAST(count(*) AS BIGINT) AS rows, {r6('avg((ps = cs)::INT)', 'signal_agreement_rate')}, {_counts} FROM shadow"))
def e17(spark, sf_dir):
    s = monitor.shadow_summary(shadow(spark, sf_dir))
    return s.withColumn("signal_agreement_rate", rnd("signal_agreement_rate"))


@query("e18_ab_comparison", sql(["shadow"], f"""
SELECT *, candidate_trade_signals >= 30 AS candidate_signals_meet_minimum, candidate_trade_signals <= greatest(1, production_trade_signals) * 3 AS alert_frequency_safe,
       candidate_trade_signals >= 30 AND candidate_trade_signals <= greatest(1, production_trade_signals) * 3 AS promotion_recommended_after_shadow
FROM (SELECT CAST(count(*) AS BIGINT) AS rows, {r6('avg((ps = cs)::INT)', 'signal_agreement_rate')}, CAST(count(*) FILTER (ps <> 'no_trade') AS BIGINT) AS production_trade_signals,
      CAST(count(*) FILTER (cs <> 'no_trade') AS BIGINT) AS candidate_trade_signals, CAST(count(*) FILTER (cs <> 'no_trade' AND ps = 'no_trade') AS BIGINT) AS candidate_only_signals,
      CAST(count(*) FILTER (ps <> 'no_trade' AND cs = 'no_trade') AS BIGINT) AS production_only_signals, {r6('avg(ctop)', 'avg_candidate_confidence')},
      {r6('avg(top)', 'avg_production_confidence')}, {r6('avg(cq)', 'avg_candidate_trade_quality')}, {r6('avg(q)', 'avg_production_trade_quality')} FROM shadow)"""))
def e18(spark, sf_dir):
    c = monitor.compare(shadow(spark, sf_dir))
    return c.withColumns({x: rnd(x) for x in c.columns if x.startswith("avg_") or x == "signal_agreement_rate"})


def model_metrics(spark, sf_dir):
    """One model per symbol: macro F1 of its predictions and its fixed-exit trade results."""
    f1 = ev.summary(classified(spark, sf_dir), "y", "predicted", ["symbol"]).select("symbol", F.col("macro_f1").alias("direction_macro_f1"))
    t = trades(spark, sf_dir).where("strategy = 'ema_trend'")
    pf = out.trade_metrics(t, ["symbol"]).select("symbol", F.col("profit_factor").alias("backtest_profit_factor"), "expectancy_r")
    dd = metrics(spark, sf_dir).where("strategy = 'ema_trend'").select("symbol", "max_drawdown_pct")
    return f1.join(pf, "symbol", "left").join(dd, "symbol", "left").withColumnRenamed("symbol", "model_id")


@query("e19_promotion_gate", sql(["predc", "trp", "eq"], """
, mf AS (SELECT symbol, avg(f1) FILTER (s > 0) AS f1 FROM (SELECT symbol, k, tp + fp + fn AS s, coalesce(2.0::DOUBLE * tp / nullif(2 * tp + fp + fn, 0), 0) AS f1
   FROM (SELECT symbol, k, count(*) FILTER (y = k AND c = k) AS tp, count(*) FILTER (y <> k AND c = k) AS fp, count(*) FILTER (y = k AND c <> k) AS fn FROM range(3) r(k), predc GROUP BY 1, 2)) GROUP BY 1),
mt AS (SELECT symbol, PROFIT_FACTOR AS pf, avg(rr) AS er FROM trp WHERE strategy = 'ema_trend' GROUP BY 1),
md AS (SELECT symbol, min((equity - peak) / peak) * 100 AS dd FROM eq WHERE strategy = 'ema_trend' GROUP BY 1),
mm AS (SELECT mf.symbol, f1, coalesce(pf, 0) AS pf, coalesce(er, 0) AS er, coalesce(dd, 0) AS dd FROM mf LEFT JOIN mt USING (symbol) LEFT JOIN md USING (symbol))
SELECT model_id, production_id, g1 AS beats_production_macro_f1, g2 AS positive_expectancy, g3 AS profit_factor_ok, g4 AS drawdown_acceptable, g1 AND g2 AND g3 AND g4 AS approved
FROM (SELECT c.symbol AS model_id, p.symbol AS production_id, c.f1 - p.f1 >= 0.01 AS g1, NOT t OR c.er > 0 AS g2, NOT t OR c.pf >= 1.1 AS g3, NOT t OR abs(c.dd) <= abs(p.dd) * 1.1 OR p.dd = 0 AS g4
      FROM (SELECT *, pf > 0 OR er <> 0 AS t FROM mm WHERE symbol <> 'click') c, (SELECT * FROM mm WHERE symbol = 'click') p)""").replace("\n, mf", ", mf").replace("PROFIT_FACTOR", PROFIT_FACTOR))
def e19(spark, sf_dir):
    m = model_metrics(spark, sf_dir)
    return monitor.promotion_gate(m.where("model_id <> 'click'"), m.where("model_id = 'click'"))
