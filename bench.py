"""Benchmark: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; print one JSON line.

Each query is fully computed into Spark's ``noop`` sink (no collect to the driver). One warm-up pass
runs first; the reported time per query is the best of ``$BENCH_REPEAT`` (default 2) timed runs.
``BENCH_QUERIES=all`` times every registered query instead of the headline set.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "transitions", "mine_transition_2", "pathways", "presence_edges", "gap_sessions", "sleep_dailies",
    "sleep_model", "activity_dailies", "activity_weeklies", "iqr_labels", "resample_15min_ffill",
    "physiology_dailies", "physiology_weeklies", "nightly_metrics", "time_cdf", "smooth_hist", "localize", "lookup_replace", "unpivot_union",
    "incremental_derive", "first_per_group", "catalog_domains",
]


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "2"))
    from homesense.plans.catalog_of_queries import REGISTRY
    from homesense.session import local_session

    names = list(REGISTRY) if os.environ.get("BENCH_QUERIES") == "all" else \
        [q for q in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if q]
    spark = local_session(cpus, shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", "8")))
    REGISTRY["transitions"].fn(spark, sf).write.format("noop").mode("overwrite").save()  # warm-up
    times = {}
    for name in names:
        best = None
        for _ in range(repeat):
            t0 = time.perf_counter()
            REGISTRY[name].fn(spark, sf).write.format("noop").mode("overwrite").save()
            dt = time.perf_counter() - t0
            best = dt if best is None else min(best, dt)
        times[name] = round(best, 3)
    sf_name = os.path.basename(sf).replace("sf", "")
    print(json.dumps({"metric": "sum_of_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(sf_name) if sf_name.replace(".", "").isdigit() else sf,
                      "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
