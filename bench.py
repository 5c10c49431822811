"""Headline queries, timed. Prints one JSON line.

BENCH_SF_DIR   input folder (default /root/testdata/sf0.1)
BENCH_CPUS     local cores (default 8)
BENCH_QUERIES  comma-separated names (default: the headline list)
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = (
    "g6_fact_orders", "g12_daily_sales_summary", "g13_customer_kpis", "g15_customer_360", "g16_product_kpis",
    "g17_store_performance", "g19_inventory_health", "g21_executive_kpi", "g22_reconciled_orders", "g28_select_returns",
    "g29_capped_refunds", "g30_running_stock", "d2_rule_counts", "d5_quality_results", "v14_validation_results",
    "m12_demand_forecast", "m14_anomaly_events", "q6_retrieval", "q15_evaluation", "h5_segment_profile", "h7_top_demand",
    "t14_managed_minutes", "a11_exact_percentiles", "w4_latest_by_key",
)


def main() -> None:
    from martloom.session import get_session

    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = os.environ.get("BENCH_QUERIES")
    spark = get_session(
        "bench", f"local[{cpus}]",
        **{"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.log.level": "ERROR",
           "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g")},
    )
    from verification import registries

    queries = {name: run for r in registries() for name, run in r.queries.items()}
    names = chosen.split(",") if chosen else HEADLINE
    # one untimed query starts the workers and compiles the common code paths
    queries["g12_daily_sales_summary"](spark, folder).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names:
        start = time.perf_counter()
        queries[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    total = round(sum(seconds.values()), 3)
    print(json.dumps({"metric": "total_seconds", "value": total, "unit": "sec", "queries": seconds,
                      "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"), "cpus": int(cpus),
                      "spark": spark.version}))
    spark.stop()


if __name__ == "__main__":
    main()
