"""Time the headline queries and print one JSON line.

Every query is built and fully computed into a sink that discards the rows.  Tables that
several queries share in a session are forgotten before each run, so each time covers
the whole chain from the given tables.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from seriesmill.catalog import QUERIES  # noqa: E402
from seriesmill.catalog.base import forget_shared  # noqa: E402
from seriesmill.session import build_session  # noqa: E402

HEADLINE = [
    "g6_bars_from_ticks", "f2_ema", "f9_macd", "f15_vwap", "f18_distance_from_year_extremes", "f22_market_structure_score",
    "j1_asof_join", "f42_onchain", "f47_feature_matrix", "l1_triple_barrier", "l3_regime", "l4_cycle", "l7_label_all",
    "d5_scaled_features", "m6_threshold_search", "t4_exit_ladder", "t8_sharpe_sortino", "e3_roc_auc", "e9_feature_drift",
    "x3_correlation_matrix", "x4_mutual_information", "g5_cooldown", "d6_sequence_windows", "m1_train_heads",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = build_session("bench", master=f"local[{cpus}]", shuffle_partitions=cpus)
    spark.sparkContext.setLogLevel("ERROR")
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    QUERIES["f1_returns"](spark, sf_dir).write.format("noop").mode("overwrite").save()  # start-up
    seconds = {}
    for name in names:
        forget_shared()
        begin = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - begin, 3)
    print(json.dumps({"metric": "headline_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
                      "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/"))}), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
