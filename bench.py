"""Wall seconds of the headline queries; prints one JSON line.

BENCH_SF_DIR names the tables, BENCH_CPUS the local cores, BENCH_QUERIES an optional list of names.
"""

from __future__ import annotations

import json
import os
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

HEADLINE = [
    "weekly_rollup", "feature_projection", "inventory_report", "reorder_alerts", "monthly_revenue",
    "correlation_matrix", "promo_box_stats", "dq_describe", "recompute_revenue", "price_elasticity",
    "optimal_price", "promo_uplift", "promo_roi", "ab_effect", "weather_impact", "zscore_anomalies",
    "gap_fill_interpolate", "classical_decompose", "stl_all_series", "isolation_forest",
    "store_clusters", "linear_regression", "random_forest", "recursive_forecast",
]


def main() -> None:
    from demandspark.catalog import QUERIES
    from demandspark.session import local_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = os.environ.get("BENCH_QUERIES", "").split() or HEADLINE
    partitions = "8" if cpus == "*" else cpus
    spark = local_session(cpus, "bench", **{"spark.sql.shuffle.partitions": partitions, "spark.driver.memory": "16g",
                                            "spark.ui.showConsoleProgress": "false"})
    spark.read.parquet(f"{sf_dir}/lineitem.parquet").groupBy("l_returnflag").count().collect()
    # One uncounted run warms the JVM.
    QUERIES["demand_stats"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({"metric": "headline_queries_wall", "value": round(sum(seconds.values()), 3), "unit": "sec",
                      "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
