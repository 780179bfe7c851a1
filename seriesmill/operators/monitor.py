"""Comparing a candidate model with the production model."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from seriesmill.operators.signals import model_signal
from seriesmill.plans.materialize import with_scalars

# Gates.
MIN_SHADOW_SIGNALS, MAX_CHATTER = 30, 3
MIN_F1_GAIN, MIN_PROFIT_FACTOR, MAX_DRAWDOWN_WORSE_PCT = 0.01, 1.10, 10.0


def action(side):
    return F.when(side == 1, "long_bias").when(side == -1, "short_bias").otherwise("no_trade")


def shadow_log(production: DataFrame, candidate: DataFrame, on: Sequence[str], **thresholds) -> DataFrame:
    """Both models' signals, probabilities and qualities on identical bars."""
    def decided(df, who):
        probs = F.create_map(F.lit("down"), F.col("p_down"), F.lit("sideways"), F.col("p_sideways"), F.lit("up"), F.col("p_up"))
        return df.select(*on, action(model_signal(**thresholds)["side"]).alias(f"{who}_signal"),
                         probs.alias(f"{who}_probs"), F.col("quality").alias(f"{who}_trade_quality"))
    return decided(production, "production").join(decided(candidate, "candidate"), list(on))


def shadow_summary(log: DataFrame) -> DataFrame:
    """Signal counts per model and how often both agree."""
    counts = [F.count(F.when(F.col(f"{who}_signal") == s, 1)).alias(f"{who}_{s}")
              for who in ("production", "candidate") for s in ("long_bias", "short_bias", "no_trade")]
    agree = F.avg((F.col("production_signal") == F.col("candidate_signal")).cast("double"))
    return log.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(agree, F.lit(0.0)).alias("signal_agreement_rate"), *counts)


def compare(log: DataFrame, min_signals: int = MIN_SHADOW_SIGNALS) -> DataFrame:
    """One-row A/B comparison with the shadow gates."""
    p, c = F.col("production_signal") != "no_trade", F.col("candidate_signal") != "no_trade"
    n_if = lambda cond: F.count(F.when(cond, 1))
    top = lambda who: F.avg(F.array_max(F.map_values(f"{who}_probs")))
    out = log.agg(
        F.count(F.lit(1)).alias("rows"),
        F.avg((F.col("production_signal") == F.col("candidate_signal")).cast("double")).alias("signal_agreement_rate"),
        n_if(p).alias("production_trade_signals"), n_if(c).alias("candidate_trade_signals"),
        n_if(c & ~p).alias("candidate_only_signals"), n_if(p & ~c).alias("production_only_signals"),
        top("candidate").alias("avg_candidate_confidence"), top("production").alias("avg_production_confidence"),
        F.avg("candidate_trade_quality").alias("avg_candidate_trade_quality"),
        F.avg("production_trade_quality").alias("avg_production_trade_quality"))
    enough = F.col("candidate_trade_signals") >= min_signals
    calm = F.col("candidate_trade_signals") <= F.greatest(F.lit(1), F.col("production_trade_signals")) * MAX_CHATTER
    return out.withColumns({"candidate_signals_meet_minimum": enough, "alert_frequency_safe": calm,
                            "promotion_recommended_after_shadow": enough & calm})


def promotion_gate(candidates: DataFrame, production: DataFrame) -> DataFrame:
    """Gate results per candidate; ``production`` holds at most one row of the same metrics.

    Without backtest metrics the trading gates are skipped; without a production model
    the comparisons are.
    """
    names = ("direction_macro_f1", "backtest_profit_factor", "max_drawdown_pct", "expectancy_r")
    prod = production.limit(1).select(F.col("model_id").alias("production_id"), *[F.col(n).alias(f"_p_{n}") for n in names])
    joined = with_scalars(candidates, prod)
    value = lambda n: F.coalesce(F.col(n), F.lit(0.0))
    cold = F.col("production_id").isNull()
    tested = (value("backtest_profit_factor") > 0) | (value("expectancy_r") != 0)
    dd, prod_dd = F.abs(value("max_drawdown_pct")), F.abs(value("_p_max_drawdown_pct"))
    gates = {
        "beats_production_macro_f1": cold | (value("direction_macro_f1") - value("_p_direction_macro_f1") >= MIN_F1_GAIN),
        "positive_expectancy": ~tested | (value("expectancy_r") > 0),
        "profit_factor_ok": ~tested | (value("backtest_profit_factor") >= MIN_PROFIT_FACTOR),
        "drawdown_acceptable": cold | ~tested | (dd <= prod_dd * (1 + MAX_DRAWDOWN_WORSE_PCT / 100.0)) | (prod_dd == 0),
    }
    approved = F.lit(True)
    for g in gates.values():
        approved = approved & g
    return joined.select("model_id", "production_id", *[g.alias(n) for n, g in gates.items()], approved.alias("approved"))
