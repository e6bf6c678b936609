"""Tier-based ARR per customer-month and its month-over-month movements."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarterlens.functions.columns import classify_movement, tier_arr
from quarterlens.operators.staging import exclude_missing_tier
from quarterlens.operators.windows import previous_value


def label_months(df: DataFrame, cal: DataFrame, month_col: str = "month",
                 how: str = "left") -> DataFrame:
    """Attach fiscal_quarter by month.  The calendar has a row per month, and Spark
    broadcasts it while its estimated size allows."""
    labels = cal.select(F.col("month_date").alias("__m"), "fiscal_quarter")
    return (df.join(labels, F.col(month_col) == F.col("__m"), how)
            .drop("__m"))


def monthly_arr(subs: DataFrame, cal: DataFrame, keep_id: bool = False) -> DataFrame:
    """customer_id, month, fiscal_quarter, plan_tier, tier_arr[, subscription_id].

    Missing-tier rows are excluded; months outside the calendar keep a NULL
    fiscal_quarter (movements need them for LAG; quarter facts drop them).
    """
    ids = ["subscription_id"] if keep_id else []
    known = exclude_missing_tier(subs).select(
        "customer_id", "month", "plan_tier", tier_arr("status", "plan_tier").alias("tier_arr"), *ids)
    return label_months(known, cal).select(
        "customer_id", "month", "fiscal_quarter", "plan_tier", "tier_arr", *ids)


def with_movements(monthly: DataFrame, skew_safe: bool = True) -> DataFrame:
    """Every customer-month with prior_arr and movement_type (NULL: no movement).

    prior_arr is the ARR of the customer's previous row *after* missing-tier
    rows are removed (row-based, so a silent gap is not churn).  Rows that tie
    on the month are ordered by subscription_id, where there is one, then by
    tier and ARR; NULL months come last.
    """
    tie = [c for c in ("subscription_id", "plan_tier") if c in monthly.columns]
    base = monthly.withColumnRenamed("tier_arr", "current_arr")
    with_prior = previous_value(base, "customer_id", "month", "current_arr", "prior_arr",
                                bucket=skew_safe, tie=tie)
    cur, prior = F.col("current_arr"), F.col("prior_arr")
    moved = F.when(prior.isNull() | (cur != prior), classify_movement(prior, cur))
    return with_prior.select("customer_id", "month", "fiscal_quarter", "plan_tier", "prior_arr",
                             "current_arr", moved.alias("movement_type"))


def arr_movements(monthly: DataFrame, skew_safe: bool = True) -> DataFrame:
    """One row per customer-month whose ARR differs from the prior known month.

    Columns: customer_id, month, fiscal_quarter, plan_tier, prior_arr,
    current_arr, arr_delta, movement_type.
    """
    changed = with_movements(monthly, skew_safe).where(F.col("movement_type").isNotNull())
    cur, prior = F.col("current_arr"), F.col("prior_arr")
    return changed.select(
        "customer_id", "month", "fiscal_quarter", "plan_tier",
        prior.cast("int").alias("prior_arr"),
        cur.cast("int").alias("current_arr"),
        (cur - F.coalesce(prior, F.lit(0))).cast("int").alias("arr_delta"),
        "movement_type",
    )
