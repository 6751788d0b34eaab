"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Every result is fully computed (noop sink). Each query runs once to warm up code generation, then
BENCH_RUNS times (default 1), and the fastest run counts.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import catalog  # noqa: E402
from shelfline.session import local_session  # noqa: E402

HEADLINE = [
    "int_daily_sales",
    "weekly_sales",
    "monthly_sales",
    "mart_sales_forecasting",
    "unpivot_days",
    "build_fact",
    "wide_sales_total",
    "clean_prices",
    "dedup_first",
    "sales_by_store",
    "top_items",
    "price_stats",
    "price_variation",
    "validate_fact",
    "check_hierarchy",
    "dq_sales",
    "gap_fill_dates",
    "feature_matrix",
    "additive_fit_predict",
    "additive_future",
    "evaluate_models",
    "safety_stock",
    "inventory_recommendations",
    "inventory_scenario",
]


def seconds(run, spark, sf_dir: str) -> float:
    started = time.perf_counter()
    run(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    wanted = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    registered = catalog.queries()
    times = {}
    for name in wanted:
        seconds(registered[name], spark, sf_dir)
        times[name] = round(min(seconds(registered[name], spark, sf_dir) for _ in range(runs)), 3)
        if os.environ.get("BENCH_VERBOSE"):
            print(name, times[name], file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")),
            }
        )
    )


if __name__ == "__main__":
    main()
