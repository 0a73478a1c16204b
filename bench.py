"""Benchmark the headline queries on the driver tables.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query runs end to end into Spark's ``noop`` sink (the whole plan
executes, nothing is collected to the driver). One warm-up run, then the
median of ``BENCH_RUNS`` (default 5) timed runs per query. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from civic_indicators.driver.queries import QUERIES  # noqa: E402
from civic_indicators.session import get_spark  # noqa: E402

HEADLINE = ("indicator_panel", "monthly_panels", "first_per_key", "distinct_concat", "outer_merge",
            "label_last_match", "column_frequencies", "pivot_counts", "guidance")


def run(spark, name: str, root: str) -> float:
    t0 = time.perf_counter()
    QUERIES[name](spark, root).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    root = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "5"))
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]
    spark = get_spark(f"local[{cpus}]", app="civic_bench", shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", int(cpus) * 2)),
                      extra={"spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("ERROR")
    times, errors = {}, {}
    for n in names:
        try:
            run(spark, n, root)
            times[n] = round(statistics.median(run(spark, n, root) for _ in range(runs)), 3)
        except Exception as e:  # noqa: BLE001 - report and go on with the other queries
            times[n], errors[n] = None, f"{type(e).__name__}: {str(e)[:200]}"
    sf = os.path.basename(root.rstrip("/")).removeprefix("sf")
    out = {"metric": "headline_total_median", "value": round(sum(t for t in times.values() if t), 3),
           "unit": "sec", "queries": times, "sf": sf, "runs": runs, "cpus": int(cpus)}
    if errors:
        out["errors"] = errors
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
