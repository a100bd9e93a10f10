"""Time the headline queries and print one JSON line.

BENCH_SF_DIR and BENCH_CPUS choose the input and the local cores; BENCH_RUNS the timed
runs per query after one warm-up (default 1, the median is reported). Results go to the
``noop`` sink, so every row is computed and none is kept.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from slotcast.registry.queries import REGISTRY
from slotcast.session import local_session

HEADLINE = [
    "slot_load",
    "source_priority_union",
    "time_interpolate",
    "weather_upsample_15m",
    "ewm_load",
    "feature_frame",
    "horizon_matrix",
    "horizon_line_fit",
    "baseline_forecast",
    "forecast_accuracy",
    "revision_deviation",
]


def timed(name: str, spark, sf_dir: str) -> float:
    start = time.perf_counter()
    REGISTRY[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    names = sys.argv[1:] or HEADLINE
    partitions = int(cpus) if cpus.isdigit() else os.cpu_count()
    spark = local_session(cpus, partitions=partitions, memory="12g")
    seconds = {}
    for name in names:
        timed(name, spark, sf_dir)
        seconds[name] = round(
            statistics.median(timed(name, spark, sf_dir) for _ in range(runs)), 3
        )
        print(f"{name}: {seconds[name]}", file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
