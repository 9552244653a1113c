"""Bench: headline queries on $BENCH_SF_DIR (default /root/testdata/sf0.1), local[$BENCH_CPUS].

Each query is forced to completion with a ``noop`` write (every row is computed, nothing
is collected to the driver). Before timing, every headline query runs once on the smallest
table set ($BENCH_WARMUP_DIR, default the sibling ``sf0.001``) so that JVM JIT and code
generation are warm; the time of that pass is reported as ``warmup_sec``. No result of the
warm-up is reused: it reads other files. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "gap_fill",
    "series_metrics",
    "harmonize_daily",
    "daily_metrics",
    "monthly_metrics",
    "combined_currency",
    "forward_fill_nonzero",
    "load_all_series",
    "serve_latest",
    "stream_consume",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from rateflow.plans.queries import QUERIES
    from rateflow.session import local_session

    spark = local_session(cores=cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8, app="rateflow-bench")
    warm_dir = os.environ.get("BENCH_WARMUP_DIR",
                              os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001"))
    if not os.path.isdir(warm_dir):
        warm_dir = sf_dir
    t0 = time.perf_counter()
    for name in HEADLINE:
        QUERIES[name](spark, warm_dir).write.format("noop").mode("overwrite").save()
    warmup = round(time.perf_counter() - t0, 3)

    times: dict[str, float] = {}
    for name in HEADLINE:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({
        "metric": "headline_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": cpus,
        "warmup_dir": warm_dir,
        "warmup_sec": warmup,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
