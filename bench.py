"""Benchmark the headline queries.

Runs each query over the driver tables in $BENCH_SF_DIR (default
/root/testdata/sf0.1) on local[$BENCH_CPUS] and prints one JSON line:
{"metric": "total_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}.

Each timing covers building the plan and executing it completely (a
``noop`` write, so no rows travel to the driver).  Every query runs once
untimed first (JVM code generation and JIT warm-up), then RUNS times; the
median is reported (the machine is shared, single runs vary by +-30%).
"gold_build" writes the five gold marts to a fresh scratch folder each run,
as the nightly rebuild would.
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

from quarterlens.plans.model import RevenueModel  # noqa: E402
from quarterlens.plans.registry import queries  # noqa: E402
from quarterlens.session import local_session  # noqa: E402

RUNS = int(os.environ.get("BENCH_RUNS", "3"))

HEADLINE = [
    "waterfall",
    "arr_movements",
    "monthly_snapshots",
    "dim_customers",
    "stg_invoices",
    "nrr_cohorts",
    "nrr_cohorts_qend",
    "movement_detail",
    "nrr_matrix",
    "bridge_check",
    "metric_avg_nrr",
    "dq_not_null",
    "dq_unique",
    "late_invoices",
]


def _run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = local_session(cpus, shuffle_partitions=max(8, 2 * cpus), app_name="quarterlens-bench")
    q = queries()

    def timed(fn) -> float:
        fn()  # warm-up
        runs = []
        for _ in range(RUNS):
            t0 = time.perf_counter()
            fn()
            runs.append(time.perf_counter() - t0)
        return round(statistics.median(runs), 3)

    times: dict[str, float] = {}
    for key in HEADLINE:
        times[key] = timed(lambda: _run(q[key](spark, sf_dir)))
    times["gold_build"] = timed(lambda: RevenueModel.from_driver(spark, sf_dir).build(
        tempfile.mkdtemp(prefix="ql-bench-gold-")))

    m = re.search(r"sf([0-9.]+)$", sf_dir)
    print(json.dumps({
        "metric": "total_sec",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
        "runs": f"median of {RUNS} warm runs",
    }))
    spark.stop()


if __name__ == "__main__":
    main()
