"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8) and
BENCH_RUNS (timed runs per query after one warm-up, default 3; the median counts).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from freightlens.registered import QUERIES
from freightlens.session import local_session, remove_run_dirs

HEADLINE = [
    "stg_order_items",
    "order_delivery_stages",
    "order_transit_shape",
    "seller_customer_distance",
    "fact_orders",
    "dim_products",
    "dim_geolocation",
    "mart_delivery_kpis",
    "mart_monthly_sales",
    "mart_satisfaction_by_delivery",
    "mart_delivery_delay_stages",
    "mart_pdt_delivery",
    "mart_delay_pdt_vs_dist",
    "mart_seller_perf",
    "mart_seller_performance",
    "mart_delivery_revenue_risk",
    "mart_delivery_sunburst",
    "mart_transit_drivers",
    "mart_transit_unclassified",
    "dq_relationships",
    "dq_header_invariant",
    "reconcile_key_digest",
    "n6_deadline_spread",
    "n8_controlled_transit",
    "n9_review_spread",
    "v6_top_sellers",
    "incremental_batch",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = local_session(cores, "bench")
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in HEADLINE:
        taken = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
        remove_run_dirs(spark)
        seconds[name] = round(statistics.median(taken[1:]), 3)
    line = {
        "metric": "total seconds of the headline queries, warm",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
        "cores": cores,
        "runs": runs,
    }
    print(json.dumps(line))


if __name__ == "__main__":
    main()
