"""Quarter-end and cohort ARR from subscription intervals, without a row per month.

An interval is a customer's run of months with one tier and status.  It adds
its ARR at its first month and takes it back after its last one, so a sum over
many customers at any month is a running sum of such changes.  The changes are
added up per month (and cohort) map-side, so what crosses the network is
bounded by the number of subscription changes, and the running sums go over a
few rows per calendar month, however many customers there are.

Intervals carry ``rows`` (+1, or -1 for what is to be taken out) besides
``arr``: months whose tier is not known have no ARR and no row (T3), so they
are intervals of their own with both negated.  A quarter exists in a result
only if some row does, as in the operators over monthly rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarterlens.functions.columns import tier_arr
from quarterlens.operators.calendar import quarter_end_months


def _month_index(month: str | Column) -> Column:
    """12 * year + month - 1, as whole number."""
    return F.year(month).cast("long") * 12 + F.month(month) - 1


def _month_of(index: Column) -> Column:
    return F.make_date(F.floor(index / 12).cast("int"), (F.pmod(index, F.lit(12)) + 1).cast("int"), F.lit(1))


def arr_intervals(spans: DataFrame, missing: DataFrame | None = None) -> DataFrame:
    """customer_id, first, after (month indexes), arr, rows of subscription spans.

    ``spans`` has customer_id, first_month, last_month, tier, status; a NULL
    tier is unknown and gives nothing.  ``missing`` has the single months
    (customer_id, month, tier, status) of known spans whose tier is not known.
    """
    known = spans.where(F.col("tier").isNotNull()).select(
        "customer_id", _month_index("first_month").alias("first"), (_month_index("last_month") + 1).alias("after"),
        tier_arr("status", "tier").cast("long").alias("arr"), F.lit(1).cast("long").alias("rows"))
    if missing is None:
        return known
    out = missing.where(F.col("tier").isNotNull()).select(
        "customer_id", _month_index("month").alias("first"), (_month_index("month") + 1).alias("after"),
        (-tier_arr("status", "tier").cast("long")).alias("arr"), F.lit(-1).cast("long").alias("rows"))
    return known.unionByName(out)


def _changes(intervals: DataFrame, *by: str) -> DataFrame:
    """month (index), arr, rows: what changes at each month, per ``by``."""
    ends = F.array(
        F.struct(F.col("first").alias("month"), F.col("arr").alias("arr"), F.col("rows").alias("rows")),
        F.struct(F.col("after").alias("month"), (-F.col("arr")).alias("arr"), (-F.col("rows")).alias("rows")))
    return (intervals.select(*by, F.inline(ends)).groupBy(*by, "month")
            .agg(F.sum("arr").alias("arr"), F.sum("rows").alias("rows")))


def _levels(changes: DataFrame, marks: DataFrame, *by: str) -> DataFrame:
    """``marks(by..., month)`` with the sums of all changes up to and with that month.

    One row per month and mark meets in a window: months of the calendar, not customers.
    """
    rows = changes.withColumn("mark", F.lit(0)).unionByName(
        marks.select(*by, "month", F.lit(0).cast("long").alias("arr"), F.lit(0).cast("long").alias("rows"),
                     F.lit(1).alias("mark")))
    upto = Window.partitionBy(*by).orderBy("month", "mark").rowsBetween(Window.unboundedPreceding, 0)
    return (rows.withColumn("arr", F.sum("arr").over(upto)).withColumn("rows", F.sum("rows").over(upto))
            .where("mark = 1").drop("mark"))


def quarter_ending(intervals: DataFrame, cal: DataFrame) -> DataFrame:
    """ARR at the last calendar month of each fiscal quarter that has a row there."""
    ends = quarter_end_months(cal).select("fiscal_quarter", _month_index("quarter_end_month").alias("month"))
    levels = _levels(_changes(intervals), ends.select("month")).where("rows > 0")
    return levels.join(ends, "month").select("fiscal_quarter", F.col("arr").cast("bigint").alias("ending_arr"))


def _cohort_bounds(cal: DataFrame) -> DataFrame:
    """cohort_quarter, its first month and the month after its last one (indexes), by the calendar."""
    return cal.groupBy(F.col("fiscal_quarter").alias("cohort_quarter")).agg(
        _month_index(F.min("month_date")).alias("q_first"), (_month_index(F.max("month_date")) + 1).alias("q_after"))


def member_intervals(cohorts: DataFrame, intervals: DataFrame, cal: DataFrame) -> DataFrame:
    """cohort_quarter, first, after, arr, rows: the members' intervals from their cohort quarter on.

    ``cohorts`` has customer_id, cohort_quarter.  A member has positive ARR in
    some month of its cohort quarter: the months that its paid intervals share
    with the quarter, less those that are taken out, are more than none.  The
    one join and the window are on the customer.
    """
    bounded = cohorts.join(_cohort_bounds(cal), "cohort_quarter")
    rows = bounded.join(intervals, "customer_id")
    shared = F.greatest(F.least("after", "q_after") - F.greatest("first", "q_first"), F.lit(0))
    paid = F.sum(F.when(F.col("arr") != 0, shared * F.col("rows")).otherwise(F.lit(0))) \
        .over(Window.partitionBy("customer_id"))
    return (rows.withColumn("paid", paid)
            .withColumn("first", F.greatest("first", "q_first"))
            .where((F.col("paid") > 0) & (F.col("first") < F.col("after")))
            .select("cohort_quarter", "first", "after", "arr", "rows"))


def cohort_forward(members: DataFrame, cal: DataFrame, measure: str = "arr_sum") -> DataFrame:
    """Members' ARR in every quarter at or after their cohort quarter.

    ``measure`` arr_sum adds up all months of a quarter, arr_qend takes its last month.
    """
    if measure not in ("arr_sum", "arr_qend"):
        raise ValueError(measure)
    changes = _changes(members, "cohort_quarter")
    months = cal.select(_month_index("month_date").alias("month"), "fiscal_quarter")
    if measure == "arr_qend":
        months = quarter_end_months(cal).select(_month_index("quarter_end_month").alias("month"), "fiscal_quarter")
    last = cal.select(_month_index(F.max("month_date"))).scalar()
    # A row per cohort and calendar month from its first change on.
    marks = changes.groupBy("cohort_quarter").agg(F.min("month").alias("from")).where(F.col("from") <= last).select(
        "cohort_quarter", F.explode(F.sequence("from", last)).alias("month"))
    levels = _levels(changes, marks, "cohort_quarter").where("rows > 0").join(months, "month")
    return levels.groupBy("cohort_quarter", "fiscal_quarter").agg(
        F.sum("arr").cast("bigint").alias("cohort_current_arr"))

