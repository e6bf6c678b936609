"""Every query the package answers, keyed by name.

Each entry takes (spark, sf_dir), builds the lazy revenue model over the
driver tables in ``sf_dir`` and returns a DataFrame over the whole tables.
Column names match the SQL in ``quarterlens.plans.oracle``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarterlens.constants import FIXTURE_VERIFIED_QUARTER
from quarterlens.operators import arr, calendar, intervals, nrr, quality, reporting, semantic, waterfall
from quarterlens.plans.model import RevenueModel
from quarterlens.session import scratch_folder
from quarterlens.sources import bronze, driver, marts

VERIFIED_QUARTER = FIXTURE_VERIFIED_QUARTER

Query = Callable[[SparkSession, str], DataFrame]


def _model(spark: SparkSession, sf_dir: str) -> RevenueModel:
    return RevenueModel.from_driver(spark, sf_dir)


def _built(spark: SparkSession, sf_dir: str) -> RevenueModel:
    return _model(spark, sf_dir).build(scratch_folder(spark, "built"))


def _q(build: Callable[[RevenueModel], DataFrame]) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return build(_model(spark, sf_dir))
    run.__doc__ = build.__doc__
    return run


def _nrr_matrix(m: RevenueModel) -> DataFrame:
    return nrr.nrr_matrix(m.nrr_cohorts, m.calendar_quarters())


# --- sources and sinks: the fixture written, read back and used ---------------

def bronze_csv_waterfall(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1: the bronze tables as (gzipped) CSV files, read back by name and type, give the waterfall."""
    root = scratch_folder(spark, "bronze-csv")
    bronze.write_bronze_tables(driver.read_bronze(spark, sf_dir), root, "csv", {"compression": "gzip"})
    return RevenueModel.from_bronze(spark, root, "csv").waterfall


def bronze_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1: subscriptions with faulty months and amounts, split into rows that read and rejected ones.

    The file has its columns in another order.  Customers 0 mod 11 have their
    months day first, customers 0 mod 13 an amount with a currency.
    """
    path = scratch_folder(spark, "bronze-faults")
    k, month, mrr = F.col("customer_id"), F.col("month").cast("string"), F.col("mrr").cast("string")
    given = driver.bronze_subscriptions(spark, sf_dir).select(
        "status", F.when(k % 13 == 0, F.concat(mrr, F.lit(" EUR"))).otherwise(mrr).alias("mrr"), "customer_id",
        F.when(k % 11 == 0, F.date_format("month", "dd/MM/yyyy")).otherwise(month).alias("month"), "plan_tier",
        "subscription_id")
    given.write.option("header", "true").csv(path)
    good, rejected = bronze.split_rows(bronze.as_it_stands(spark, path, "raw_subscriptions", "csv"), "raw_subscriptions")
    rows = good.select(F.lit("read").alias("outcome"), "mrr").unionByName(rejected.select(
        F.array_join(F.concat(F.array(F.lit("rejected")), F.col("problems.column_name")), " ").alias("outcome"),
        F.lit(None).cast("decimal(12,2)").alias("mrr")))
    return rows.groupBy("outcome").agg(F.count(F.lit(1)).alias("rows"), F.sum("mrr").cast("decimal(22,2)").alias("mrr"))


def marts_read_back(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S4: the gold layer built twice into one folder; the second version's retention, read by a reader of its own."""
    root = scratch_folder(spark, "marts")
    model = _model(spark, sf_dir)
    model.build(root)
    model.build(root)
    return marts.MartStore(spark, root).read("fct_nrr_cohorts")


def close_one_by_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S8: the close of all quarters, then of two of them again; the headlines as they stand in the folder."""
    root = scratch_folder(spark, "close")
    built = _model(spark, sf_dir).build(f"{root}/marts")
    built.write_close_report(f"{root}/close")
    for fq in (VERIFIED_QUARTER, built.waterfall.agg(F.max("fiscal_quarter")).first()[0]):
        paths = built.write_close_report(f"{root}/close", fq)
    back = marts.read_mart(spark, paths["summary"])
    return back.select("fiscal_quarter", *(c for c in back.columns if c != "fiscal_quarter"))


# --- the same metrics from intervals, without a row per month ---------------------

def _intervals(m: RevenueModel, spark: SparkSession, sf_dir: str) -> DataFrame:
    return intervals.arr_intervals(*driver.fixture_spans(spark, sf_dir))


def _members(m: RevenueModel, spark: SparkSession, sf_dir: str) -> DataFrame:
    signup = m.stg_customers.withColumn("__month", F.trunc("signup_date", "MM"))
    cohorts = arr.label_months(signup, m.calendar, "__month", "inner").select(
        "customer_id", F.col("fiscal_quarter").alias("cohort_quarter"))
    return intervals.member_intervals(cohorts, _intervals(m, spark, sf_dir), m.calendar)


def interval_quarter_ending(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O17 as a running sum of changes."""
    m = _model(spark, sf_dir)
    return intervals.quarter_ending(_intervals(m, spark, sf_dir), m.calendar)


def interval_cohort_forward(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O22 as running sums of changes per cohort."""
    m = _model(spark, sf_dir)
    return intervals.cohort_forward(_members(m, spark, sf_dir), m.calendar)


def interval_cohort_starting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O21 from the same sums."""
    return nrr.cohort_starting(interval_cohort_forward(spark, sf_dir))


def interval_nrr_qend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quarter-end retention from the running sums at the quarter ends."""
    m = _model(spark, sf_dir)
    return nrr.nrr_cohorts(intervals.cohort_forward(_members(m, spark, sf_dir), m.calendar, "arr_qend"), "nrr_pct_qend")


QUERIES: dict[str, Query] = {
    # sources
    "monthly_snapshots": _q(lambda m: m.raw_subscriptions),
    # S9 alone: the change log expanded, tiers as logged.
    "subscription_months": lambda spark, sf_dir: driver.monthly_snapshots(
        driver.subscription_changes(spark, sf_dir)),
    # The lazy form: its own plan scans the orders' date range (the model
    # uses the same rule, resolved once, as a broadcastable local table).
    "fiscal_calendar": _q(lambda m: calendar.fiscal_calendar_for(m.calendar_source,
                                                                 m.calendar_column)),
    # staging
    "stg_customers": _q(lambda m: m.stg_customers),
    "stg_subscriptions": _q(lambda m: m.stg_subscriptions),
    "stg_invoices": _q(lambda m: m.stg_invoices),
    "stg_usage_events": _q(lambda m: m.stg_usage_events),
    # core metrics
    "monthly_arr": _q(lambda m: m.monthly_arr),
    "dim_customers": _q(lambda m: m.dim_customers),
    "arr_movements": _q(lambda m: m.arr_movements),
    "arr_movements_skew_safe": lambda spark, sf_dir: RevenueModel.from_driver(
        spark, sf_dir, skew_safe=True).arr_movements,
    "quarterly_movements": _q(lambda m: m.quarterly_movements),
    "quarter_ending": _q(lambda m: m.quarter_ending),
    "waterfall": _q(lambda m: m.waterfall.orderBy("fiscal_quarter")),
    "cohort_members": _q(lambda m: m.cohort_members),
    "cohort_starting": _q(lambda m: m.cohort_starting),
    "cohort_forward": _q(lambda m: m.cohort_forward),
    "nrr_cohorts": _q(lambda m: m.nrr_cohorts.orderBy("cohort_quarter", "fiscal_quarter")),
    "nrr_cohorts_qend": _q(lambda m: m.nrr_cohorts_qend),
    # reporting
    "movement_detail": _q(lambda m: reporting.movement_detail(m.arr_movements)
                          .orderBy("fiscal_quarter", F.col("arr_delta").desc())),
    "close_summary": _q(lambda m: reporting.close_summary(m.waterfall)),
    "waterfall_summary": _q(lambda m: reporting.waterfall_summary(m.waterfall)
                            .orderBy("fiscal_quarter")),
    "close_nrr": _q(lambda m: reporting.close_nrr(m.nrr_cohorts)
                    .orderBy("fiscal_quarter", "cohort_quarter")),
    "arr_bridge": _q(lambda m: reporting.arr_bridge(m.waterfall)),
    "nrr_matrix": _q(_nrr_matrix),
    "nrr_bands": _q(lambda m: nrr.nrr_bands(m.nrr_cohorts)),
    "nrr_latest": _q(lambda m: nrr.nrr_latest(m.nrr_cohorts)),
    "nrr_trend": _q(lambda m: nrr.nrr_trend(m.nrr_cohorts)),
    "cohort_list": _q(lambda m: m.nrr_cohorts.select("cohort_quarter").distinct()
                      .orderBy("cohort_quarter")),
    "quarter_list": _q(lambda m: m.waterfall.select("fiscal_quarter").distinct()
                       .orderBy("fiscal_quarter")),
    "qoq_series": _q(lambda m: waterfall.qoq_series(m.waterfall)),
    "churn_series": _q(lambda m: waterfall.churn_series(m.waterfall)),
    "churn_spike": _q(lambda m: waterfall.churn_spike(m.waterfall)),
    "yoy_growth": _q(lambda m: waterfall.yoy_growth(m.waterfall)),
    "bridge_check": _q(lambda m: waterfall.bridge_check(m.waterfall)),
    "movement_distribution": _q(lambda m: reporting.movement_distribution(m.arr_movements)),
    # semantic layer
    "metric_waterfall": _q(lambda m: semantic.metric(
        {"revenue_waterfall": m.waterfall},
        ["total ARR", "net new", "churn", "expansion"], by=["quarter"])),
    "metric_avg_nrr": _q(lambda m: semantic.metric(
        {"nrr_cohorts": m.nrr_cohorts}, "average retention", by=["measurement quarter"])),
    "metric_fact_synonym": _q(lambda m: semantic.metric(
        {"revenue_waterfall": m.waterfall}, ["closing ARR", "upsell ARR", "growth rate"], by=["FQ"])),
    "metric_where": _q(lambda m: semantic.metric(
        {"revenue_waterfall": m.waterfall}, ["opening ARR", "lost ARR"],
        where={"period": VERIFIED_QUARTER})),
    "metric_nrr_by_cohort": _q(lambda m: semantic.metric(
        {"nrr_cohorts": m.nrr_cohorts}, "NRR", by=["signup quarter"])),
    "vq_quarter_waterfall": _q(lambda m: semantic.vq_quarter_waterfall(m.waterfall,
                                                                       VERIFIED_QUARTER)),
    "vq_growth_trend": _q(lambda m: semantic.vq_growth_trend(m.waterfall)),
    "vq_nrr_by_cohort": _q(lambda m: semantic.vq_nrr_by_cohort(m.nrr_cohorts)),
    # data quality
    # Over marts written once; the NULLs of those are counted while they are written.
    "dq_not_null": lambda spark, sf_dir: (lambda m: quality.run_not_null(m.dq_tables(), m.observed))(
        _built(spark, sf_dir)),
    "dq_unique": lambda spark, sf_dir: (lambda m: quality.run_unique(m.dq_tables(), m.observed))(
        _built(spark, sf_dir)),
    "dq_accepted_values": _q(lambda m: quality.run_accepted_values(m.dq_tables())),
    "dq_dedup_audit": _q(lambda m: quality.dedup_audit("stg_invoices", m.raw_invoices,
                                                       m.stg_invoices)),
    "dq_nrr_grain": _q(lambda m: quality.grain_check(
        "fct_nrr_cohorts", m.nrr_cohorts, ["cohort_quarter", "fiscal_quarter"])),
    "dq_missing_tier": _q(lambda m: quality.missing_tier_audit(m.stg_subscriptions)),
    "late_invoices": _q(lambda m: quality.late_invoices(m.stg_invoices)),
    **{f.__name__: f for f in (bronze_csv_waterfall, bronze_quarantine, marts_read_back, close_one_by_one,
                               interval_quarter_ending, interval_cohort_forward, interval_cohort_starting,
                               interval_nrr_qend)},
}

FLAGSHIP = "waterfall"


def queries() -> dict[str, Query]:
    return dict(QUERIES)
