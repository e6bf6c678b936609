"""Cohort net revenue retention.

A cohort is the set of customers whose signup falls in a fiscal quarter and
who had positive ARR in that quarter.  The customer-month ARR is aggregated
once to customer-quarter (sum, max and quarter-end value); one join with the
customers' cohort gives membership, forward ARR and starting ARR in a single
pass, and every output is at most (#quarters)^2 rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarterlens.functions.columns import nrr_band, pct
from quarterlens.operators.calendar import quarter_end_months


def customer_quarters(monthly: DataFrame, cal: DataFrame | None = None) -> DataFrame:
    """customer_id, fiscal_quarter, arr_sum, arr_max[, arr_qend] over in-calendar months.

    ``arr_qend`` (only when ``cal`` is given) is the ARR of the quarter's last
    calendar month, NULL when the customer has no row that month.  Grouping by
    (customer_id, fiscal_quarter) reuses an existing customer partitioning, so
    on the snapshot pipeline this aggregate needs no shuffle.
    """
    known = monthly.where(F.col("fiscal_quarter").isNotNull())
    aggs = [F.sum("tier_arr").cast("bigint").alias("arr_sum"),
            F.max("tier_arr").alias("arr_max")]
    if cal is not None:
        ends = quarter_end_months(cal).select(F.col("quarter_end_month").alias("__qe"))
        known = known.join(ends, F.col("month") == F.col("__qe"), "left")
        aggs.append(F.sum(F.when(F.col("__qe").isNotNull(), F.col("tier_arr")))
                    .cast("bigint").alias("arr_qend"))
    return known.groupBy("customer_id", "fiscal_quarter").agg(*aggs)


def cohort_assignment(dim: DataFrame) -> DataFrame:
    """customer_id, cohort_quarter for customers whose signup has a fiscal quarter."""
    return (dim.where(F.col("signup_fiscal_quarter").isNotNull())
            .select("customer_id", F.col("signup_fiscal_quarter").alias("cohort_quarter")))


def cohort_quarters(dim: DataFrame, cust_q: DataFrame) -> DataFrame:
    """Each cohort customer's quarters from its cohort quarter on, with a membership flag.

    A member had positive ARR in some month of its own signup quarter.  The
    join is on customer_id only (the quarter test is a residual filter), so
    the customer-partitioned aggregate stays in place and only the
    one-row-per-customer side moves; the flag is a window over the same
    partitioning, bounded by the number of quarters per customer.
    """
    joined = (cohort_assignment(dim).join(cust_q, "customer_id")
              .where(F.col("fiscal_quarter") >= F.col("cohort_quarter")))
    at_start = (F.col("fiscal_quarter") == F.col("cohort_quarter")) & (F.col("arr_max") > 0)
    member = F.max(F.when(at_start, F.lit(1)).otherwise(F.lit(0))) \
        .over(Window.partitionBy("customer_id")) == 1
    return joined.withColumn("is_member", member)


def cohort_members(cohort_q: DataFrame) -> DataFrame:
    """customer_id, cohort_quarter of the members (one row each: the customer-quarter
    aggregate has one row per customer and quarter)."""
    return (cohort_q.where((F.col("fiscal_quarter") == F.col("cohort_quarter"))
                           & (F.col("arr_max") > 0))
            .select("customer_id", "cohort_quarter"))


def cohort_forward(cohort_q: DataFrame, measure: str = "arr_sum") -> DataFrame:
    """Members' ARR in every quarter at or after their cohort quarter.

    ``measure`` arr_sum sums every month (the model's definition); arr_qend
    uses quarter-end snapshots, skipping customers without a row that month.
    """
    rows = cohort_q.where(F.col("is_member") & F.col(measure).isNotNull())
    return (rows.groupBy("cohort_quarter", "fiscal_quarter")
            .agg(F.sum(measure).cast("bigint").alias("cohort_current_arr")))


def cohort_starting(forward: DataFrame) -> DataFrame:
    """Starting ARR of each cohort: its forward value in the cohort quarter itself
    (the same member rows the model sums for the signup quarter)."""
    return forward.where(F.col("fiscal_quarter") == F.col("cohort_quarter")).select(
        "cohort_quarter", F.col("cohort_current_arr").alias("cohort_starting_arr"))


def nrr_cohorts(forward: DataFrame, pct_name: str = "nrr_pct") -> DataFrame:
    """cohort_quarter, fiscal_quarter, cohort_starting_arr, cohort_current_arr, nrr_pct.

    The starting ARR is read off the cohort's own row with a window over the
    forward aggregate (at most #quarters rows per cohort), so the monthly data
    is aggregated once; a cohort without a starting row has no rows, like the
    model's inner join, and a cohort with no rows in a quarter has no row
    there (not 0%).
    """
    own = F.col("fiscal_quarter") == F.col("cohort_quarter")
    start = F.max(F.when(own, F.col("cohort_current_arr"))) \
        .over(Window.partitionBy("cohort_quarter"))
    return (forward.withColumn("cohort_starting_arr", start)
            .where(F.col("cohort_starting_arr").isNotNull())
            .select("cohort_quarter", "fiscal_quarter", "cohort_starting_arr",
                    "cohort_current_arr",
                    pct("cohort_current_arr", "cohort_starting_arr").alias(pct_name)))


def nrr_cohorts_qend(cohort_q: DataFrame) -> DataFrame:
    """NRR measured on quarter-end snapshots instead of summed months.

    Starting ARR = members' ARR at the last month of the cohort quarter;
    current ARR = their ARR at the last month of each later quarter.  Without
    growth this stays at 100%, unlike the summed-months ratio.
    """
    return nrr_cohorts(cohort_forward(cohort_q, "arr_qend"), "nrr_pct_qend")


# --- reporting views over nrr_cohorts (all at most #quarters^2 rows) ------

def nrr_bands(nrr: DataFrame) -> DataFrame:
    return nrr.select("cohort_quarter", "fiscal_quarter", "nrr_pct",
                      nrr_band("nrr_pct").alias("nrr_band"))


def nrr_latest(nrr: DataFrame) -> DataFrame:
    """Cohorts measured in the latest quarter, with their band.

    The latest quarter is a one-row aggregate joined on the quarter label
    (an equi-join with a single-row side), not a window over all rows.
    """
    latest = nrr.agg(F.max("fiscal_quarter").alias("fiscal_quarter"))
    return nrr.join(F.broadcast(latest), "fiscal_quarter").select(
        "fiscal_quarter", "cohort_quarter", "nrr_pct", nrr_band("nrr_pct").alias("signal"))


def nrr_trend(nrr: DataFrame) -> DataFrame:
    """Each cohort's NRR series in quarter order, with its position."""
    w = Window.partitionBy("cohort_quarter").orderBy("fiscal_quarter")
    return nrr.select("cohort_quarter", "fiscal_quarter", "nrr_pct",
                      F.row_number().over(w).cast("int").alias("quarter_index"))


def nrr_matrix(nrr: DataFrame, quarters: list[str]) -> DataFrame:
    """Cohort rows x quarter columns of nrr_pct.

    ``quarters`` fixes the columns (taken from the calendar, not the data),
    so the schema never depends on what the data happens to contain.  A cell
    with more than one row is an error that names it, whatever the rows hold.
    """
    cells = nrr.groupBy("cohort_quarter", "fiscal_quarter").agg(
        F.count(F.lit(1)).alias("__rows"), F.max("nrr_pct").alias("__pct"))
    twice = F.concat(F.lit("NRR has "), F.col("__rows").cast("string"), F.lit(" rows for cohort "),
                     F.coalesce("cohort_quarter", F.lit("NULL")), F.lit(" in quarter "),
                     F.coalesce("fiscal_quarter", F.lit("NULL")))
    cell = F.when(F.col("__rows") > 1, F.raise_error(twice).cast("double")).otherwise(F.col("__pct"))
    return (cells.select("cohort_quarter", "fiscal_quarter", cell.alias("nrr_pct"))
            .groupBy("cohort_quarter")
            .pivot("fiscal_quarter", quarters)
            .agg(F.max("nrr_pct")))
