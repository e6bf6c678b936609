"""Summarise the physical plans of the headline queries into PLANS.md.

For each query: shuffles (hash / single-partition), broadcasts, join
strategies, aggregate kinds, windows, parquet scans with their read schema,
and whether any Python evaluation appears.  Plans are taken after one run,
so adaptive execution has settled (final plan).  Automatic broadcasts are off,
so that small test tables show the joins that large ones get.
"""

from __future__ import annotations

import os
import re
import sys
from collections import Counter

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from quarterlens.plans.registry import queries  # noqa: E402
from quarterlens.session import local_session  # noqa: E402

KEYS = ["waterfall", "arr_movements", "monthly_snapshots", "dim_customers", "stg_invoices",
        "nrr_cohorts", "nrr_cohorts_qend", "dq_not_null"]

PATTERNS = {
    "parquet scans": r"FileScan parquet",
    "hash shuffles": r"Exchange hashpartitioning",
    "single-partition shuffles": r"Exchange SinglePartition",
    "reused shuffles": r"ReusedExchange",
    "broadcasts": r"BroadcastExchange",
    "broadcast hash joins": r"BroadcastHashJoin",
    "sort-merge joins": r"SortMergeJoin",
    "nested-loop / cartesian": r"BroadcastNestedLoopJoin|CartesianProduct",
    "hash aggregates": r"HashAggregate",
    "sort aggregates": r"SortAggregate",
    "windows": r"\bWindow \[",
    "python evaluation": r"BatchEvalPython|ArrowEvalPython|FlatMapGroupsInPandas",
}


def final_form(plan: str) -> str:
    """The plan without the initial forms that it and each of its subqueries print after the final ones."""
    out, initial = [], None
    for line in plan.splitlines():
        depth = len(line) - len(line.lstrip(" :+-"))
        if initial is not None and depth >= initial:
            continue
        initial = depth if "== Initial Plan ==" in line else None
        if initial is None:
            out.append(line)
    return "\n".join(out)


def summarise(plan: str) -> tuple[Counter, list[str]]:
    plan = final_form(plan)
    counts = Counter({k: len(re.findall(p, plan)) for k, p in PATTERNS.items()})
    scans = sorted(set(re.findall(r"file:[^\]]*/(\w+)\.parquet\].*?ReadSchema: (struct<[^>]*>)",
                                  plan)))
    return counts, [f"{t}: {s}" for t, s in scans]


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session(8, 16)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    out = [f"# Physical plans of the headline queries\n\nGenerated by `tools/plan_report.py` "
           f"on `{sf_dir}` (local[8], AQE on, automatic broadcast off; final adaptive plans after one run).\n"]
    q = queries()
    for key in KEYS:
        df = q[key](spark, sf_dir)
        qe = df._jdf.queryExecution()
        qe.toRdd().count()  # runs this very plan on the JVM, so AQE finalises it in place
        plan = qe.executedPlan().toString()
        counts, scans = summarise(plan)
        out.append(f"## `{key}`\n")
        out.append("| property | count |\n|---|---|")
        out += [f"| {k} | {v} |" for k, v in counts.items()]
        out.append("\nScans (table: read schema):\n")
        out += [f"* `{s}`" for s in scans]
        out.append("")
    with open(os.path.join(ROOT, "PLANS.md"), "w") as f:
        f.write("\n".join(out) + "\n")
    spark.stop()


if __name__ == "__main__":
    main()
