"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query runs to completion through the ``noop`` sink (every row and column
is produced, nothing is collected to the driver).  Prints one JSON line.
``--all`` times every registered query instead of the headline set.

Before timing, the same queries run once, untimed, on the smallest fixture
($BENCH_WARMUP_DIR, default /root/testdata/sf0.001 when present), so the
numbers are steady-state query times rather than JVM class loading and JIT.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from hearth.plans.registry import REGISTRY  # noqa: E402
from hearth.session import local_session  # noqa: E402

HEADLINE = [
    "fct_rent_trends",
    "mart_neighborhood_scorecard",
    "mart_inventory_churn",
    "mart_transit_price_effect",
    "fct_listing_history",
    "dim_listings",
    "dim_neighborhoods",
    "int_neighborhood_development_signals",
    "stg_permits",
    "agg_avg_median",
    "merge_upsert",
    "merge_insert_new",
    "unpivot_dates",
    "envelope_build",
    "quality_report",
    "check_unique",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    keys = list(REGISTRY) if "--all" in sys.argv else HEADLINE
    spark = local_session(cpus, shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", "16")), app="hearth-bench")
    warm_dir = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")
    if os.path.isdir(warm_dir) and os.path.abspath(warm_dir) != os.path.abspath(sf_dir):
        for key in keys:  # warm-up: class loading, codegen and JIT on tiny data, not timed
            REGISTRY[key].spark(spark, warm_dir).write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    for key in keys:
        t0 = time.perf_counter()
        REGISTRY[key].spark(spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[key] = round(time.perf_counter() - t0, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
