"""Bronze tables derived from the driver's TPC-H-like parquet tables.

The revenue model reads four raw billing tables.  The test data has none, so
each is derived from the driver tables by the deterministic rules of
FIXTURES.md section 2.  Every rule is a column expression, a pre-aggregated
group-by or a window, so the mapping runs distributed at any scale.

All readers select only the columns they need, so the parquet scan's
ReadSchema stays narrow.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarterlens.constants import (
    FIXTURE_CHURN_MODULUS,
    FIXTURE_MISSING_TIER,
    FIXTURE_MRR_NOISE,
    FIXTURE_TIER_BOUNDS,
    STATUS_ACTIVE,
    STATUS_CHURNED,
    TIER_MRR,
)
from quarterlens.functions.columns import month_start
from quarterlens.operators.windows import next_value

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
                 "events", "documents", "embeddings", "pages", "benchmark", "labels",
                 "conversations")

# Declared schemas of the driver tables the model reads: no footer sampling at
# read time, and a changed file type fails loudly instead of drifting.
DRIVER_SCHEMAS = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, "
                "c_mktsegment STRING",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
              "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, "
                "l_quantity DOUBLE, l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, "
                "l_returnflag STRING, l_linestatus STRING, l_shipdate TIMESTAMP_NTZ",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, "
              "value DOUBLE, props STRING",
}


class DriverTables:
    """Reads each driver table once (declared schema) and hands out
    projections; Catalyst pushes each projection into the parquet scan."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self._frames: dict[str, DataFrame] = {}

    def __call__(self, name: str, *columns: str) -> DataFrame:
        if name not in DRIVER_TABLES:
            raise ValueError(f"unknown driver table {name!r}")
        if name not in self._frames:
            reader = self.spark.read
            if name in DRIVER_SCHEMAS:
                reader = reader.schema(DRIVER_SCHEMAS[name])
            self._frames[name] = reader.parquet(f"{self.sf_dir}/{name}.parquet")
        df = self._frames[name]
        return df.select(*columns) if columns else df


def _tables(spark_or_tables, sf_dir: str | None) -> DriverTables:
    if isinstance(spark_or_tables, DriverTables):
        return spark_or_tables
    return DriverTables(spark_or_tables, sf_dir)


def read_table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """Read one driver table, optionally projecting columns right at the scan."""
    return DriverTables(spark, sf_dir)(name, *columns)


def fixture_tier(totalprice: Column) -> Column:
    low, high = FIXTURE_TIER_BOUNDS
    return (F.when(totalprice < F.lit(low), F.lit("Starter"))
            .when(totalprice < F.lit(high), F.lit("Growth"))
            .otherwise(F.lit("Enterprise")))


def subscription_changes(spark: SparkSession | DriverTables, sf_dir: str | None = None
                         ) -> DataFrame:
    """One plan change per (customer, month): the month's last order.

    Columns: customer_id, change_month, tier, status.
    The "last order" is a max over a struct (order date, order key, price):
    an aggregate with a partial (map-side) step, so a customer with a huge
    number of orders is reduced to one row per month and input partition
    before the shuffle instead of landing in one task.
    """
    orders = _tables(spark, sf_dir)("orders", "o_orderkey", "o_custkey", "o_orderdate",
                                    "o_totalprice")
    last = (
        orders
        .groupBy(F.col("o_custkey").alias("customer_id"),
                 month_start("o_orderdate").alias("change_month"))
        .agg(F.max(F.struct("o_orderdate", "o_orderkey", "o_totalprice")).alias("o"))
    )
    return last.select(
        "customer_id",
        "change_month",
        fixture_tier(F.col("o.o_totalprice")).alias("tier"),
        F.when(F.col("o.o_orderkey") % FIXTURE_CHURN_MODULUS == 0, F.lit(STATUS_CHURNED))
        .otherwise(F.lit(STATUS_ACTIVE)).alias("status"),
    )


def change_spans(changes: DataFrame, period_end: str | Column | None = None) -> DataFrame:
    """Subscription change log -> one row per run of months with one tier and status.

    ``changes`` has customer_id, change_month, tier, status; the result
    customer_id, first_month, last_month, tier, status.  A churned change lasts
    one month (the customer is then silent until the next change); any other
    change lasts until the month before the customer's next change, the last
    one until ``period_end`` (default: the latest change month in the data).
    Changes after ``period_end`` and months beyond it are left out.  The next
    change comes from a LEAD window.
    """
    # Changes are unique per (customer, month), so one customer has at most
    # one row per month of history: the plain window's groups are bounded.
    spans = next_value(changes, "customer_id", "change_month", "change_month", "next_change",
                       bucket=False)
    if period_end is None:
        # Uncorrelated scalar subquery: evaluated once, then used as a literal.
        end_col = changes.select(F.max("change_month")).scalar()
    elif isinstance(period_end, Column):
        end_col = period_end
    else:
        end_col = F.to_date(F.lit(period_end))
    spans = spans.withColumn("period_end", F.trunc(end_col, "MM"))
    last = (F.when(F.col("status") == F.lit(STATUS_CHURNED), F.col("change_month"))
            .when(F.col("next_change").isNotNull(), F.add_months("next_change", -1))
            .otherwise(F.col("period_end")))
    # ``least`` skips NULLs, so a change log without a period end stays whole.
    spans = spans.withColumn("last", F.least(last, "period_end")).where(F.col("last") >= F.col("change_month"))
    return spans.select("customer_id", F.col("change_month").alias("first_month"), F.col("last").alias("last_month"),
                        "tier", "status")


def monthly_snapshots(changes: DataFrame, period_end: str | Column | None = None) -> DataFrame:
    """Subscription change log -> one row per customer and month.

    customer_id, month, plan_tier, status, with tier and status as logged: the
    months of ``change_spans``, expanded with ``explode(sequence(...))``.
    """
    return change_spans(changes, period_end).select(
        "customer_id",
        F.explode(F.sequence("first_month", "last_month", F.expr("interval 1 month"))).alias("month"),
        F.col("tier").alias("plan_tier"), "status")


def fixture_spans(spark: SparkSession | DriverTables, sf_dir: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(spans, single months of them whose tier is missing by rule 5 of FIXTURES.md).

    The rule hits every ``FIXTURE_MISSING_TIER[1]``-th month of a customer, so a
    span is expanded to those months alone.
    """
    t = _tables(spark, sf_dir)
    end = t("orders", "o_orderdate").select(month_start(F.max("o_orderdate"))).scalar()
    spans = change_spans(subscription_changes(t), end)
    mult, mod = FIXTURE_MISSING_TIER
    first, last = (F.year(c).cast("bigint") * 12 + F.month(c) for c in ("first_month", "last_month"))
    hit = first + F.pmod(-(F.col("customer_id").cast("bigint") * mult + first), F.lit(mod))
    hits = spans.withColumn("hit", hit).withColumn("end", last).where(F.col("hit") <= F.col("end"))
    months = hits.withColumn("ym", F.explode(F.sequence("hit", "end", F.lit(mod).cast("bigint"))))
    month = F.make_date(F.floor((F.col("ym") - 1) / 12).cast("int"), (F.pmod(F.col("ym") - 1, F.lit(12)) + 1).cast("int"),
                        F.lit(1))
    return spans, months.select("customer_id", month.alias("month"), "tier", "status")


def bronze_subscriptions(spark: SparkSession | DriverTables, sf_dir: str | None = None,
                         period_end: str | Column | None = None, missing_tiers: bool = True
                         ) -> DataFrame:
    """The fixture's raw subscriptions: snapshots with an id, missing tiers and a noisy MRR.

    Rules 5 to 7 of FIXTURES.md; ``missing_tiers=False`` leaves out rule 5.
    """
    t = _tables(spark, sf_dir)
    if period_end is None:
        period_end = t("orders", "o_orderdate").select(month_start(F.max("o_orderdate"))).scalar()
    snap = monthly_snapshots(subscription_changes(t), period_end)
    k = F.col("customer_id").cast("bigint")
    ym = F.year("month").cast("bigint") * 12 + F.month("month")
    tier_mult, tier_mod = FIXTURE_MISSING_TIER
    mrr_mult, mrr_mod, mrr_base = FIXTURE_MRR_NOISE
    plan_tier = F.col("plan_tier")
    if missing_tiers:
        plan_tier = F.when((k * tier_mult + ym) % tier_mod != 0, plan_tier)
    # Prices are whole hundreds, so price * (90 + noise) / 100 is an integer:
    # (price / 100) * (90 + noise), all in integer arithmetic.
    hundreds = F.coalesce(
        *[F.when(plan_tier == F.lit(t), F.lit(p // 100)) for t, p in TIER_MRR.items()],
        F.lit(TIER_MRR["Starter"] // 100)).cast("bigint")
    mrr = (hundreds * (F.lit(mrr_base) + (k * mrr_mult + ym) % mrr_mod)).cast("decimal(12,2)")
    return snap.select(
        F.concat(F.lit("SUB-"), k.cast("string"), F.lit("-"), ym.cast("string"))
        .alias("subscription_id"),
        F.col("customer_id"),
        F.col("month"),
        plan_tier.alias("plan_tier"),
        mrr.alias("mrr"),
        F.col("status"),
    )


def bronze_customers(spark: SparkSession | DriverTables, sf_dir: str | None = None
                     ) -> DataFrame:
    """customer_id, signup_date (first order), region (via nation), initial_plan_tier."""
    t = _tables(spark, sf_dir)
    customer = t("customer", "c_custkey", "c_nationkey")
    nation = t("nation", "n_nationkey", "n_regionkey")
    region = t("region", "r_regionkey", "r_name")
    orders = t("orders", "o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    first = (orders.groupBy(F.col("o_custkey").alias("c_custkey"))
             .agg(F.min(F.struct("o_orderdate", "o_orderkey", "o_totalprice")).alias("o")))
    # nation/region are fixed-size TPC-H dimensions (25 / 5 rows): Spark's own
    # size estimate broadcasts them; no hint needed.
    geo = nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        "n_nationkey", "r_name")
    return (
        customer.join(geo, customer.c_nationkey == geo.n_nationkey, "left")
        .join(first, "c_custkey", "left")
        .select(
            F.col("c_custkey").alias("customer_id"),
            F.col("o.o_orderdate").cast("date").alias("signup_date"),
            F.col("r_name").alias("region"),
            F.when(F.col("o").isNotNull(), fixture_tier(F.col("o.o_totalprice")))
            .alias("initial_plan_tier"),
        )
    )


INVOICE_TIE_BREAK = "source_order"


def bronze_invoices(spark: SparkSession | DriverTables, sf_dir: str | None = None
                    ) -> DataFrame:
    """Raw invoices from lineitem x orders; the key repeats, copies differ.

    Besides the five model columns the frame carries ``source_order``, a
    struct (extended price, part key, supplier key) that makes "keep the
    first copy" a total order.
    """
    t = _tables(spark, sf_dir)
    li = t("lineitem", "l_orderkey", "l_linenumber", "l_shipdate", "l_extendedprice",
           "l_partkey", "l_suppkey")
    orders = t("orders", "o_orderkey", "o_custkey", "o_orderdate")
    return li.join(orders, li.l_orderkey == orders.o_orderkey).select(
        F.concat(F.lit("INV-"), F.col("l_orderkey").cast("string"), F.lit("-"),
                 F.col("l_linenumber").cast("string")).alias("invoice_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("l_shipdate").cast("date").alias("invoice_date"),
        month_start("o_orderdate").alias("period_month"),
        F.col("l_extendedprice").cast("decimal(12,2)").alias("amount"),
        F.struct("l_extendedprice", "l_partkey", "l_suppkey").alias(INVOICE_TIE_BREAK),
    )


def bronze_usage_events(spark: SparkSession | DriverTables, sf_dir: str | None = None
                        ) -> DataFrame:
    ev = _tables(spark, sf_dir)("events", "event_id", "user_id", "ts", "event_type")
    return ev.select(
        F.col("event_id"),
        F.col("user_id").alias("customer_id"),
        F.col("ts").cast("date").alias("event_date"),
        F.col("event_type"),
    )


def read_bronze(spark: SparkSession | DriverTables, sf_dir: str | None = None,
                period_end: str | None = None) -> dict[str, DataFrame]:
    """The four declared bronze sources, as lazy DataFrames."""
    t = _tables(spark, sf_dir)
    return {
        "raw_customers": bronze_customers(t),
        "raw_subscriptions": bronze_subscriptions(t, period_end=period_end),
        "raw_invoices": bronze_invoices(t),
        "raw_usage_events": bronze_usage_events(t),
    }
