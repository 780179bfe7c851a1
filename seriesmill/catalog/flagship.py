"""The flagship query: from raw ticks to the latest state of every series."""

from __future__ import annotations

from pyspark.sql import functions as F

from seriesmill.catalog.base import ORACLES, query, r6, sql
from seriesmill.catalog.dataset import KEYS, ms
from seriesmill.catalog.features import HOURLY
from seriesmill.functions.scalar import classify, rnd
from seriesmill.operators import indicators as ind, rows, scorecard as sc, structure as stc
from seriesmill.sources.ticks import bars


def latest_state(spark, sf_dir):
    df = ind.on_bars(bars(spark, sf_dir), HOURLY, stc.add_swings, ind.add_bollinger, ind.add_true_range, before=20)
    last = rows.latest(df, KEYS)
    return last.select(
        "symbol", ms(), rnd("close").alias("close"), rnd("bb_pct_b").alias("bb_pct_b"), rnd("true_range").alias("true_range"),
        rnd("last_swing_high").alias("last_swing_high"), classify(F.col("bb_mean_reversion_signal"), sc.BOLLINGER).alias("bollinger_state"))


query("entry_latest_state")(latest_state)
_text = sql(["bb", "moves", "swx"], f"""
SELECT symbol, ts_ms, {r6('close', 'close')}, {r6('(close - lower) / nullif(upper - lower, 0)', 'bb_pct_b')}, {r6('true_range', 'true_range')},
       {r6('lsh', 'last_swing_high')}, CASE WHEN close > upper THEN 'above_upper' WHEN close < lower THEN 'below_lower' ELSE 'neutral' END AS bollinger_state
FROM bb JOIN (SELECT symbol, i, true_range FROM moves) m USING (symbol, i) JOIN (SELECT symbol, i, lsh FROM swx) s USING (symbol, i) WHERE i = n - 1""")
query("flagship_latest_state", _text)(latest_state)
ORACLES.pop("entry_latest_state", None)
