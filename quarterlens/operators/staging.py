"""Bronze -> silver cleaning operators (lazy; nothing is written).

Each one is a projection with casts, plus one de-duplication.  They accept
bronze columns typed either as text (as the original loader stored them) or
already typed; ``cast`` handles both.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def stage_customers(raw: DataFrame) -> DataFrame:
    """Rename, cast signup_date, trim region only."""
    return raw.select(
        F.col("customer_id"),
        F.col("signup_date").cast("date").alias("signup_date"),
        F.trim(F.col("region")).alias("region"),
        F.col("initial_plan_tier"),
    )


def stage_subscriptions(raw: DataFrame) -> DataFrame:
    """Cast month/mrr and flag (never drop) rows with a NULL plan tier.

    An empty string is a tier value, not a missing one.
    """
    return raw.select(
        F.col("subscription_id"),
        F.col("customer_id"),
        F.col("month").cast("date").alias("month"),
        F.col("plan_tier"),
        F.col("mrr").cast("decimal(12,2)").alias("mrr"),
        F.col("status"),
        F.col("plan_tier").isNull().alias("is_missing_tier"),
    )


def stage_invoices(raw: DataFrame, tie_break: Sequence[str] = ()) -> DataFrame:
    """Keep the first row per invoice_id by invoice_date (NULL dates last).

    ``tie_break`` columns complete the order so the pick is deterministic
    when copies share a date; they are dropped from the output.

    The pick is a group-by with a ``min`` over a struct (sort key, payload)
    rather than ``row_number() = 1``: it aggregates map-side, so an id that
    repeats a billion times is reduced to one row per input partition before
    the shuffle, and the result is the same row the window would keep.
    """
    payload = ["customer_id", "invoice_date", "period_month", "amount"]
    sort_key = [F.col("invoice_date").isNull().alias("_k0"),  # false < true: NULLs last
                F.col("invoice_date").alias("_k1")]
    sort_key += [F.col(c).alias(f"_t{i}") for i, c in enumerate(tie_break)]
    first = (raw.groupBy("invoice_id")
             .agg(F.min(F.struct(*sort_key, *[F.col(c) for c in payload])).alias("_r")))
    return first.select(
        F.col("invoice_id"),
        F.col("_r.customer_id").alias("customer_id"),
        F.col("_r.invoice_date").cast("date").alias("invoice_date"),
        F.col("_r.period_month").cast("date").alias("period_month"),
        F.col("_r.amount").cast("decimal(12,2)").alias("amount"),
    )


def stage_usage_events(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("event_id"),
        F.col("customer_id"),
        F.col("event_date").cast("date").alias("event_date"),
        F.col("event_type"),
    )


def exclude_missing_tier(subs: DataFrame) -> DataFrame:
    """Rows whose tier is unknown cannot be given an ARR; facts skip them."""
    return subs.where(~F.col("is_missing_tier"))
