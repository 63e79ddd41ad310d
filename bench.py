"""Seconds per query at $BENCH_SF_DIR on local[$BENCH_CPUS], as one JSON line.

Every query runs once to warm up and then BENCH_RUNS times; the median counts.
BENCH_ONLY=name,name restricts the run.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from accountwatch.catalog.queries import QUERIES
from accountwatch.session import local_session


def seconds(run) -> float:
    begin = time.perf_counter()
    run().write.format("noop").mode("overwrite").save()
    return time.perf_counter() - begin


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 8))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    only = [name for name in os.environ.get("BENCH_ONLY", "").split(",") if name]
    spark = local_session(cpus)
    spark.sparkContext.setLogLevel("ERROR")
    timings = {}
    for name in only or QUERIES:
        def run(name=name):
            return QUERIES[name](spark, sf_dir)

        seconds(run)
        timings[name] = round(statistics.median(seconds(run) for _ in range(runs)), 3)
    result = {
        "metric": "total_query_seconds",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "cpus": cpus,
        "runs": runs,
    }
    spark.stop()
    print(json.dumps(result))


if __name__ == "__main__":
    main()
