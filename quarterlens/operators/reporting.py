"""Report datasets behind the dashboards and the quarter-close workbook.

The original computes these for one selected quarter on a client.  Here each
is a DataFrame over *all* quarters; a caller narrows it with ``for_quarter``
(a bound value, never SQL text formatting) and collects a few rows at most.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarterlens.constants import BRIDGE_COMPONENTS


def for_quarter(df: DataFrame, fq: str, column: str = "fiscal_quarter") -> DataFrame:
    return df.where(F.col(column) == F.lit(fq))


def require_quarters(df: DataFrame, quarters: Sequence[str], what: str = "result") -> DataFrame:
    """The rows of ``df`` for the asked quarters; one without a row fails the query that reads it.

    The asked labels are left-joined to the rows and a miss raises, so the
    check is part of the plan and costs no job of its own.
    """
    asked = df.sparkSession.createDataFrame([(q,) for q in quarters], "fiscal_quarter string")
    here = df.where(F.col("fiscal_quarter").isin(*quarters)).withColumn("__here", F.lit(True))
    missing = F.concat(F.lit(f"no {what} for fiscal quarter "), F.col("fiscal_quarter"))
    found = F.when(F.col("__here").isNull(), F.raise_error(missing).cast("boolean")).otherwise(F.col("__here"))
    return asked.join(here, "fiscal_quarter", "left").where(found).select(*df.columns)


def movement_detail(movements: DataFrame) -> DataFrame:
    """Per quarter and type: movement rows (labelled customers, as in the
    original, though it counts rows) and their summed delta."""
    return (movements.where(F.col("fiscal_quarter").isNotNull())
            .groupBy("fiscal_quarter", "movement_type")
            .agg(F.count(F.lit(1)).alias("customers"),
                 F.sum("arr_delta").cast("bigint").alias("arr_delta")))


def movement_distribution(movements: DataFrame) -> DataFrame:
    """Rows per movement type over the whole table (the noise diagnostic)."""
    return movements.groupBy("movement_type").agg(F.count(F.lit(1)).alias("movements"))


def close_summary(waterfall: DataFrame) -> DataFrame:
    """Headline row per quarter; missing beginning / net new / QoQ read as 0."""
    return waterfall.select(
        "fiscal_quarter",
        "ending_arr",
        F.coalesce("beginning_arr", F.lit(0).cast("bigint")).alias("beginning_arr"),
        F.coalesce("net_new_arr", F.lit(0).cast("bigint")).alias("net_new_arr"),
        F.coalesce("qoq_growth_pct", F.lit(0.0)).alias("qoq_growth_pct"),
        "churn_arr",
        "expansion_arr",
    )


def waterfall_summary(waterfall: DataFrame) -> DataFrame:
    """The summary table of the revenue page: eight waterfall columns."""
    return waterfall.select("fiscal_quarter", "beginning_arr", "new_arr", "expansion_arr",
                            "contraction_arr", "churn_arr", "ending_arr", "qoq_growth_pct")


def close_nrr(nrr: DataFrame) -> DataFrame:
    """NRR tab: cohorts measured in each quarter."""
    return nrr.select("fiscal_quarter", "cohort_quarter", "cohort_starting_arr",
                      "cohort_current_arr", "nrr_pct")


def arr_bridge(waterfall: DataFrame) -> DataFrame:
    """Long form of the bridge: seven ordered components per quarter."""
    stack_args = ", ".join(
        f"{i + 1}, '{label}', {col}, '{measure}'"
        for i, (label, col, measure) in enumerate(BRIDGE_COMPONENTS))
    src = waterfall.select(
        "fiscal_quarter",
        F.coalesce("beginning_arr", F.lit(0).cast("bigint")).alias("beginning_arr"),
        *[F.col(c).cast("bigint").alias(c) for _, c, _ in BRIDGE_COMPONENTS[1:]])
    return src.select(
        "fiscal_quarter",
        F.expr(f"stack({len(BRIDGE_COMPONENTS)}, {stack_args}) "
               "as (position, component, arr, measure)"),
    ).select("fiscal_quarter", F.col("position").cast("int").alias("position"),
             "component", F.col("arr").cast("bigint").alias("arr"), "measure")


def close_report(waterfall: DataFrame, movements: DataFrame, nrr: DataFrame,
                 fq: str | None = None) -> dict[str, DataFrame]:
    """The three data tabs of the quarter close, for one quarter or all.

    A quarter that is asked for and has no headline row fails the summary.
    """
    tabs = {
        "summary": close_summary(waterfall),
        "movements": movement_detail(movements),
        "nrr": close_nrr(nrr),
    }
    if fq is not None:
        tabs = {k: for_quarter(v, fq) for k, v in tabs.items()}
        tabs["summary"] = require_quarters(close_summary(waterfall), [fq], "headline row")
    return tabs
