"""Times the headline queries and prints one line of JSON.

BENCH_SF_DIR  tables to read (default /root/testdata/sf0.1)
BENCH_CPUS    cores of the local session (default 8)
BENCH_ONLY    comma-separated query names instead of the headline set

Each query runs once to warm up and three times on the clock; the median counts.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from checks.compare import session  # noqa: E402
from checks.queries import QUERIES  # noqa: E402

HEADLINE = [
    "landing_orders_raw", "landing_load_report", "landing_second_batch",
    "stg_orders", "int_orders_enriched", "dim_customers", "agg_daily_revenue",
    "incremental_state_merge", "incremental_fact_affected_keys",
    "history_customer_versions", "history_tier_at_order", "history_snapshot_runs",
    "dq_check_report", "dq_scorecard",
    "srv_headline_kpis", "srv_by_country", "srv_top_customers", "srv_events_by_op",
    "srv_drift_onset", "srv_layer_counts",
]
RUNS = 3


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    only = os.environ.get("BENCH_ONLY")
    names = only.split(",") if only else HEADLINE
    spark = session(os.environ.get("BENCH_CPUS", "8"))
    times: dict[str, float] = {}
    for name in names:
        laps = []
        for _ in range(RUNS + 1):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            laps.append(time.perf_counter() - start)
        times[name] = round(statistics.median(laps[1:]), 3)
        print(name, times[name], file=sys.stderr, flush=True)
    found = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(found.group(1)) if found else None,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
