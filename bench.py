"""Benchmark: run every registered query over the tables in $BENCH_SF_DIR on
local[$BENCH_CPUS] and print one JSON line.

Each query is executed in full with the ``noop`` sink (every row is
produced, nothing is collected to the driver). Every query first runs once,
untimed, on the smallest tables ($BENCH_WARMUP_DIR, default sf0.001), so
one-time JVM JIT and code-generation costs are not charged to whichever
query happens to use an expression first; the timed runs measure the steady
state. Each query then runs $BENCH_REPEAT times (default 1) on
$BENCH_SF_DIR and the best time is kept. Queries over stored models share one
model run a session; the first of them is charged with building it.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ledgerlens.queries import QUERIES  # noqa: E402
from ledgerlens.session import clear_materialized, local_session  # noqa: E402


def _sf(sf_dir: str):
    m = re.search(r"sf([0-9.]+)", sf_dir)
    return float(m.group(1)) if m else None


def run_query(spark, fn, sf_dir: str) -> float:
    t0 = time.perf_counter()
    fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = max(1, int(os.environ.get("BENCH_REPEAT", "1")))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    spark = local_session(cores=cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8)

    warm_dir = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")
    if not os.path.isdir(warm_dir):
        warm_dir = sf_dir
    for name, fn in QUERIES.items():  # untimed warm-up on the smallest tables
        if not only or name in only:
            run_query(spark, fn, warm_dir)
    clear_materialized(spark)  # the timed queries share a model run of their own

    times: dict[str, float] = {}
    for name, fn in QUERIES.items():
        if only and name not in only:
            continue
        times[name] = round(min(run_query(spark, fn, sf_dir) for _ in range(repeat)), 3)
        print(f"# {name}: {times[name]:.3f}s", file=sys.stderr, flush=True)

    print(json.dumps({
        "metric": "total_query_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": _sf(sf_dir),
        "cpus": cpus,
    }))
    clear_materialized(spark)
    spark.stop()


if __name__ == "__main__":
    main()
