"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints ONE JSON line: {"metric", "value", "unit", "queries", "sf", ...}.
Each query is executed to completion with the ``noop`` sink (the whole plan
runs, nothing is collected); the reported time is the median of
$BENCH_RUNS runs after one warm-up run.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "gold_booking_funnel",
    "gold_center_revenue",
    "gold_subscription_metrics",
    "gold_session_utilization",
    "gold_user_ltv",
    "gold_center_lifecycle",
    "silver_booking",
    "silver_payment",
    "dedup_latest",
    "upsert_merge",
    "upsert_bucketed",
    "scd2_second_load",
    "stream_silver_booking",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]

    from lakepipe.plans import catalog
    from lakepipe.session import build_session

    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=max(cpus, 8), app="lakepipe-bench")
    qs = catalog.queries()
    names = only or HEADLINE
    timings: dict[str, float] = {}
    failed: dict[str, str] = {}
    for name in names:
        fn = qs[name]

        def once():
            t0 = time.perf_counter()
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            return time.perf_counter() - t0

        try:
            once()  # warm-up: JIT, file listing caches, Python imports
            timings[name] = round(statistics.median(once() for _ in range(runs)), 3)
        except Exception as e:  # noqa: BLE001 - reported in the JSON, the other queries still run
            failed[name] = f"{type(e).__name__}: {str(e)[:200]}"
            print(f"# {name}: FAILED {failed[name]}", file=sys.stderr, flush=True)
            continue
        print(f"# {name}: {timings[name]}s", file=sys.stderr, flush=True)

    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "sum_of_median_query_seconds",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": float(m.group(1)) if m else sf_dir,
                "cpus": cpus,
                "runs": runs,
                **({"failed": failed} if failed else {}),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
