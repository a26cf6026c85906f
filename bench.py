"""Benchmark: time the registered queries on ``$BENCH_SF_DIR`` with ``local[$BENCH_CPUS]``.

Prints one JSON line: ``{"metric", "value", "unit", "queries": {...}, "sf"}``.
Each query runs to completion through Spark's ``noop`` sink (full execution,
no collect to the driver), including building its plan; the median of
``$BENCH_RUNS`` (default 3) runs is kept, after an untimed run.  ``value`` is the
flagship planner time, ``flagship_rows_per_sec`` its waypoints by that time; the
sum over all queries is reported as ``total_sec``.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from flightlake.catalog import QUERIES  # noqa: E402
from flightlake.session import build_session, run_folder  # noqa: E402

# Headline queries first (the user-level jobs), then every other operator.
HEADLINE = ["planner_flagship", "airport_markers", "path_with_risk", "arrivals_table",
            "flight_picker_lastwins", "trail_every_nth", "latest_position", "future_path"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    extra = {"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEM", "16g"),
             "spark.checkpoint.dir": os.environ.get("BENCH_CHECKPOINT") or tempfile.mkdtemp(prefix="bench-checkpoint-")}
    extra.update(json.loads(os.environ.get("BENCH_CONF", "{}")))  # experiments
    spark = build_session("flightlake-bench", master=f"local[{cpus}]",
                          shuffle_partitions=max(8, 2 * cpus), extra=extra)
    names = only or HEADLINE + [q for q in QUERIES if q not in HEADLINE]

    runs = int(os.environ.get("BENCH_RUNS", "3"))
    times: dict[str, float] = {}
    for name in names:
        each = []
        with run_folder(spark):  # what a query writes in between goes with it
            for k in range(runs + 1):  # building the plan is part of each run; the first is not timed
                t0 = time.perf_counter()
                QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
                each.append(time.perf_counter() - t0)
        times[name] = round(statistics.median(each[1:]), 3)
    rows = QUERIES["planner_flagship"](spark, sf_dir).count() if "planner_flagship" in times else 0

    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "planner_flagship_sec",
        "value": times.get("planner_flagship", round(sum(times.values()), 3)),
        "unit": "sec",
        "flagship_rows_per_sec": round(rows / times["planner_flagship"]) if rows else None,
        "total_sec": round(sum(times.values()), 3),
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
