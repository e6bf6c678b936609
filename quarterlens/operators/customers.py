"""Customer dimension: signup quarter, first month and latest status."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarterlens.operators.arr import label_months


def customer_activity(subs: DataFrame) -> DataFrame:
    """customer_id, first_active_month, current_status in one aggregate.

    first_active_month is min(month) over *all* rows (any status, missing
    tiers included).  current_status is the status of the latest month, where
    a row without a month counts as the latest (the warehouse ranks by month
    descending, which puts NULLs first) and the greater status wins a tie.
    Rows are first combined map-side per customer and status, in buffers of
    fixed width (a hash aggregate, which holds a row per group; one over
    statuses would sort all rows of a task), then those few per customer.
    """
    per_status = subs.groupBy("customer_id", "status").agg(
        F.min("month").alias("first"), F.max("month").alias("last"),
        F.max(F.col("month").isNull()).alias("undated"))
    latest = F.struct("undated", F.when(~F.col("undated"), F.col("last")), "status")
    return per_status.groupBy("customer_id").agg(
        F.min("first").alias("first_active_month"),
        F.max_by("status", latest).alias("current_status"),
    )


def dim_customers(customers: DataFrame, subs: DataFrame, cal: DataFrame) -> DataFrame:
    """Every staged customer, enriched; LEFT joins keep customers without data."""
    signup = customers.withColumn("__signup_month", F.trunc("signup_date", "MM"))
    labelled = label_months(signup, cal, "__signup_month").withColumnRenamed(
        "fiscal_quarter", "signup_fiscal_quarter")
    return (
        labelled.join(customer_activity(subs), "customer_id", "left")
        .select("customer_id", "signup_date", "region", "initial_plan_tier",
                "first_active_month", "signup_fiscal_quarter", "current_status")
    )
