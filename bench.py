"""Times the headline queries and prints one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_RUNS (default 1 timed run after one warm-up), BENCH_QUERIES (comma-separated names, or
``all``; default the headline queries).
Each time covers building the plan, any intermediate tables, and a full evaluation of every
output row and column by the no-op sink.
"""

from __future__ import annotations

import json
import os
import time
from pathlib import Path

from tillwise.session import local_session
from tillwise.workload.queries import QUERIES

HEADLINE = (
    "normalize_transactions",
    "store_day_activity",
    "comparison_group",
    "comparison_store_count",
    "annual_cohort_yoy",
    "period_over_period",
    "unpack_yoy_changes",
    "contribution_daypart",
    "pivot_daily_sale",
    "item_share_per_customer",
    "share_histogram",
    "prior_buyer_rollcall",
    "funnel_new_buyers",
    "composition_top10",
    "target_customer_history",
    "visit_rank",
    "visit_return_rate",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    chosen = os.environ.get("BENCH_QUERIES")
    names = list(QUERIES) if chosen == "all" else chosen.split(",") if chosen else HEADLINE
    spark = local_session(cores)

    def evaluate(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    seconds = {}
    for name in names:
        evaluate(name)
        seconds[name] = round(min(evaluate(name) for _ in range(runs)), 3)
    sf = Path(sf_dir).name.removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "total time of the queries listed",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
