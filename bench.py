"""Time the headline queries and print one JSON line. BENCH_SF_DIR and BENCH_CPUS set data and cores."""

from __future__ import annotations

import json
import os
import re
import sys
import time

from ebbline.catalog import QUERIES
from ebbline.session import build_session

HEADLINE = (
    "activity_daily_rollup",
    "churn_rate_by_snapshot",
    "cohort_historical_buyers",
    "features_product_buy",
    "features_page_visit",
    "features_search",
    "feature_table",
    "binary_metrics",
    "threshold_sweep",
    "top_k_strategy",
    "error_profile",
    "rolling_metrics",
    "orders_cohort_sizes",
    "orders_buy_features",
    "roi_simulation",
    "run_comparison",
    "feature_importance",
)
REPEATS = int(os.environ.get("BENCH_REPEATS", "2"))


def run(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = build_session("bench", master=f"local[{cpus}]", shuffle_partitions=cpus)
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in HEADLINE:
        times[name] = round(min(run(spark, name, sf_dir) for _ in range(REPEATS)), 3)
        print(name, times[name], file=sys.stderr, flush=True)
    found = re.search(r"sf([0-9.]+)", sf_dir)
    result = {
        "metric": "total time of the headline queries, best of repeats",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(found.group(1)) if found else None,
    }
    spark.stop()
    print(json.dumps(result))


if __name__ == "__main__":
    main()
