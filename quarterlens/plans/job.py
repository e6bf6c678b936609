"""Batch job: rebuild the gold layer, check it, export the close report.

    spark-submit quarterlens/plans/job.py --bronze <folder or schema> --out <root>
    spark-submit quarterlens/plans/job.py --sf-dir <driver tables> --out <root>

Reads the four bronze tables (or derives them from the driver tables), writes the five gold marts and the
data-quality results below ``<out>`` (``marts.MartStore``: a new version, committed when it is complete), writes the
quarter-close datasets to ``<out>/gold/close_report``, and fails (exit 1) when a declared check fails.  With
``--quarantine``, bronze rows that cannot be read as declared go there instead of failing the job.
The checkpoint folder comes from ``spark.checkpoint.dir`` (set by the
cluster); only a local run picks its own.
"""

from __future__ import annotations

import argparse
import os
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F


# Adaptive execution re-plans at runtime: coalesces small shuffle partitions,
# splits skewed join partitions (a hot order key in lineitem x orders), and
# turns a join into a broadcast once the real size of a side is known.
RUNTIME_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def main(argv: list[str] | None = None) -> int:
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(
        os.path.abspath(__file__)))))
    from quarterlens.plans.model import RevenueModel
    from quarterlens.session import ensure_checkpoint_dir
    from quarterlens.sources import marts

    ap = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    source = ap.add_mutually_exclusive_group(required=True)
    source.add_argument("--bronze", help="folder or catalog schema with the four bronze tables")
    source.add_argument("--sf-dir", help="folder with the driver parquet tables")
    ap.add_argument("--format", default="parquet", help="of the bronze tables: a file format, or table")
    ap.add_argument("--out", required=True, help="root folder of the layers")
    ap.add_argument("--quarter", help="close only this quarter: the other quarters' datasets stay; print its headline")
    ap.add_argument("--quarantine", help="folder for the rejected bronze rows")
    args = ap.parse_args(argv)

    spark = SparkSession.builder.appName("quarterlens-gold").getOrCreate()
    for key, value in RUNTIME_DEFAULTS.items():  # only where the cluster left them unset
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)
    ensure_checkpoint_dir(spark)
    model = (RevenueModel.from_bronze(spark, args.bronze, args.format, quarantine=args.quarantine) if args.bronze
             else RevenueModel.from_driver(spark, args.sf_dir)).build(args.out)

    store = marts.MartStore(spark, args.out)
    store.publish({"dq_results": model.data_quality()})
    model.write_close_report(marts.mart_path(args.out, "close_report"), args.quarter)
    failed = store.read("dq_results").where(F.col("failures") > 0)
    if args.quarter:
        model.close_report(args.quarter)["summary"].show(truncate=False)
    if not failed.isEmpty():
        failed.show(truncate=False)
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
