"""The revenue model as one object of lazy DataFrames.

``RevenueModel.from_driver(spark, sf_dir)`` wires bronze -> silver -> gold.
Nothing runs until an action; each property is built once and reused, so a
query that needs several marts shares their plans (and Spark reuses the
common exchanges).  ``build`` materialises the gold marts with a full
overwrite and returns a model whose gold frames read those files back, which
also cuts the lineage for everything downstream.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarterlens.constants import DEFAULT_CALENDAR_MONTHS, DEFAULT_CALENDAR_START
from quarterlens.operators import (
    arr,
    calendar,
    customers,
    nrr,
    quality,
    reporting,
    staging,
    waterfall,
)
from quarterlens.sources import driver, marts
from quarterlens.sources.bronze import read_bronze_tables
from quarterlens.sources.driver import INVOICE_TIE_BREAK

#: Gold mart -> attribute of the model.
MARTS = {"dim_fiscal_calendar": "calendar", "dim_customers": "dim_customers",
         "fct_arr_movements": "arr_movements", "fct_revenue_waterfall": "waterfall",
         "fct_nrr_cohorts": "nrr_cohorts"}
GOLD_MARTS = tuple(MARTS)


BRONZE = ("raw_customers", "raw_subscriptions", "raw_invoices", "raw_usage_events")


class RevenueModel:
    """Lazy revenue model over four bronze tables.

    ``bronze`` maps each of BRONZE to a DataFrame, or to a zero-argument
    callable building it on first use (so a query that needs one table
    never plans the others).
    """

    def __init__(self, spark: SparkSession,
                 bronze: Mapping[str, DataFrame | Callable[[], DataFrame]],
                 calendar_source: DataFrame | None = None,
                 calendar_column: str = "month",
                 skew_safe: bool = True):
        missing = set(BRONZE) - set(bronze)
        if missing:
            raise ValueError(f"missing bronze tables: {sorted(missing)}")
        self.spark = spark
        self.bronze = dict(bronze)
        # Frame whose date range spans the calendar (whole fiscal quarters);
        # None -> the model's default fixed calendar.
        self.calendar_source = calendar_source
        self.calendar_column = calendar_column
        # Bronze tables supplied from outside carry no grain guarantee (the
        # original never tests customer-month uniqueness), so movements use the
        # bucketed, skew-safe LAG by default.
        self.skew_safe = skew_safe
        # Counts that ``build`` has observed while it wrote a table.
        self.observed: dict[str, dict[str, int]] = {}

    def _raw(self, name: str) -> DataFrame:
        src = self.bronze[name]
        if callable(src) and not isinstance(src, DataFrame):
            src = self.bronze[name] = src()
        return src

    @property
    def raw_customers(self) -> DataFrame:
        return self._raw("raw_customers")

    @property
    def raw_subscriptions(self) -> DataFrame:
        return self._raw("raw_subscriptions")

    @property
    def raw_invoices(self) -> DataFrame:
        return self._raw("raw_invoices")

    @property
    def raw_usage_events(self) -> DataFrame:
        return self._raw("raw_usage_events")

    def with_bronze(self, **replace: DataFrame) -> RevenueModel:
        """A fresh model sharing this one's inputs except the replaced tables."""
        model = RevenueModel(self.spark, {**self.bronze, **replace}, self.calendar_source,
                             self.calendar_column, self.skew_safe)
        for resolved in ("calendar_span", "calendar"):  # they stay valid
            if resolved in self.__dict__:
                model.__dict__[resolved] = self.__dict__[resolved]
        return model

    @classmethod
    def from_driver(cls, spark: SparkSession, sf_dir: str, skew_safe: bool = False
                    ) -> RevenueModel:
        """Model over the driver tables.

        The subscriptions derived here have one row per customer and month by
        construction (a group-by on both, then disjoint month ranges), so a
        customer holds at most one row per month of history however skewed
        the orders are; the plain LAG is bounded and reuses the customer
        partitioning the snapshot step already produced (no extra shuffle).
        """
        tables = driver.DriverTables(spark, sf_dir)
        bronze = {
            "raw_customers": lambda: driver.bronze_customers(tables),
            "raw_subscriptions": lambda: driver.bronze_subscriptions(tables),
            "raw_invoices": lambda: driver.bronze_invoices(tables),
            "raw_usage_events": lambda: driver.bronze_usage_events(tables),
        }
        return cls(spark, bronze, calendar_source=tables("orders", "o_orderdate"),
                   calendar_column="o_orderdate", skew_safe=skew_safe)

    @classmethod
    def from_bronze(cls, spark: SparkSession, location: str, fmt: str = "parquet",
                    skew_safe: bool = True, quarantine: str | None = None,
                    options: Mapping[str, str] | None = None) -> RevenueModel:
        """Model over the four declared bronze tables in a folder or catalog schema.

        The calendar spans the months of the subscriptions and of the signups.
        Rows that cannot be read as declared fail the queries that meet them,
        or are written to ``quarantine`` and left out.
        """
        tables = read_bronze_tables(spark, location, fmt, options, quarantine)
        seen = (tables["raw_subscriptions"].select("month").unionByName(
            tables["raw_customers"].select(F.col("signup_date").alias("month"))))
        return cls(spark, tables, calendar_source=seen, calendar_column="month", skew_safe=skew_safe)

    # --- silver ----------------------------------------------------------
    @cached_property
    def stg_customers(self) -> DataFrame:
        return staging.stage_customers(self.raw_customers)

    @cached_property
    def stg_subscriptions(self) -> DataFrame:
        return staging.stage_subscriptions(self.raw_subscriptions)

    @cached_property
    def stg_invoices(self) -> DataFrame:
        tie = [INVOICE_TIE_BREAK] if INVOICE_TIE_BREAK in self.raw_invoices.columns else []
        return staging.stage_invoices(self.raw_invoices, tie)

    @cached_property
    def stg_usage_events(self) -> DataFrame:
        return staging.stage_usage_events(self.raw_usage_events)

    # --- gold ------------------------------------------------------------
    @cached_property
    def calendar_span(self) -> tuple[str, int]:
        """(first month, months), resolved by one two-value aggregate on first use."""
        if self.calendar_source is None:
            return DEFAULT_CALENDAR_START, DEFAULT_CALENDAR_MONTHS
        return calendar.calendar_span(self.calendar_source, self.calendar_column)

    @cached_property
    def calendar(self) -> DataFrame:
        return calendar.fiscal_calendar(self.spark, *self.calendar_span)

    @cached_property
    def monthly_arr(self) -> DataFrame:
        return arr.monthly_arr(self.stg_subscriptions, self.calendar)

    @cached_property
    def dim_customers(self) -> DataFrame:
        return customers.dim_customers(self.stg_customers, self.stg_subscriptions,
                                       self.calendar)

    @cached_property
    def monthly_arr_by_id(self) -> DataFrame:
        return arr.monthly_arr(self.stg_subscriptions, self.calendar, keep_id=True)

    @cached_property
    def arr_movements(self) -> DataFrame:
        return arr.arr_movements(self.monthly_arr_by_id, skew_safe=self.skew_safe)

    @cached_property
    def quarterly_movements(self) -> DataFrame:
        return waterfall.quarterly_movements(self.arr_movements)

    @cached_property
    def quarter_ending(self) -> DataFrame:
        return waterfall.quarter_ending(self.monthly_arr, self.calendar)

    @cached_property
    def waterfall(self) -> DataFrame:
        months = arr.with_movements(self.monthly_arr_by_id, skew_safe=self.skew_safe)
        return waterfall.waterfall_from_months(months, self.calendar)

    @cached_property
    def customer_quarters(self) -> DataFrame:
        return nrr.customer_quarters(self.monthly_arr, self.calendar)

    @cached_property
    def cohort_quarters(self) -> DataFrame:
        return nrr.cohort_quarters(self.dim_customers, self.customer_quarters)

    @cached_property
    def cohort_members(self) -> DataFrame:
        return nrr.cohort_members(self.cohort_quarters)

    @cached_property
    def cohort_forward(self) -> DataFrame:
        return nrr.cohort_forward(self.cohort_quarters)

    @cached_property
    def cohort_starting(self) -> DataFrame:
        return nrr.cohort_starting(self.cohort_forward)

    @cached_property
    def nrr_cohorts(self) -> DataFrame:
        return nrr.nrr_cohorts(self.cohort_forward)

    @cached_property
    def nrr_cohorts_qend(self) -> DataFrame:
        return nrr.nrr_cohorts_qend(self.cohort_quarters)

    def calendar_quarters(self) -> list[str]:
        """Quarter labels of the calendar, in order, from its rule (no job of their own)."""
        return calendar.quarter_labels(*self.calendar_span)

    def close_report(self, fq: str | None = None) -> dict[str, DataFrame]:
        if fq is not None and fq not in self.calendar_quarters():
            raise KeyError(f"fiscal quarter {fq!r} is not in the calendar")
        return reporting.close_report(self.waterfall, self.arr_movements, self.nrr_cohorts, fq)

    def write_close_report(self, path: str, fq: str | None = None, fmt: str = "parquet") -> dict[str, str]:
        """Write the close datasets of one quarter, leaving the others as they are, or of all quarters."""
        return marts.write_close_report(self.close_report(fq), path, fmt, [fq] if fq is not None else None)

    def dq_tables(self) -> dict[str, DataFrame]:
        return {
            "stg_customers": self.stg_customers,
            "stg_subscriptions": self.stg_subscriptions,
            "stg_invoices": self.stg_invoices,
            "stg_usage_events": self.stg_usage_events,
            "dim_fiscal_calendar": self.calendar,
            "dim_customers": self.dim_customers,
            "fct_arr_movements": self.arr_movements,
            "fct_revenue_waterfall": self.waterfall,
            "fct_nrr_cohorts": self.nrr_cohorts,
        }

    def data_quality(self) -> DataFrame:
        """The declared checks; of tables that ``build`` has written, with what it observed."""
        return quality.run_all(self.dq_tables(), self.observed)

    # --- materialisation -------------------------------------------------
    def build(self, root: str, concurrent_writes: int = 4, as_tables: bool = False,
              buckets: int | None = None) -> RevenueModel:
        """Rebuild silver and gold and return a model that reads them back.

        ``root`` is a folder (``marts.MartStore``) or, with ``as_tables``, the
        prefix of the layers' catalog schemas (``marts.CatalogMarts``).
        ``stg_subscriptions`` feeds every mart but the calendar, so it is
        written first, as a silver table: each mart reads only its columns, and
        a lost executor reads it again.  The marts are independent jobs over it
        and are submitted together.  Nothing that readers see changes before
        all are complete; a build that fails leaves the version before it.

        ``buckets``, for tables: the silver tables are bucketed by customer and
        sorted by month, so that the LAG, the customer aggregates and the joins
        on the customer need no shuffle.  A bucket is one task's, so this is
        for data with a bounded number of rows a customer.
        """
        if buckets and not as_tables:
            raise ValueError("buckets need catalog tables")
        target = marts.CatalogMarts(self.spark, root) if as_tables else marts.MartStore(self.spark, root)
        silver = ["stg_subscriptions"] + (["stg_customers"] if buckets else [])
        names = [("silver", n) for n in silver] + [("gold", n) for n in MARTS]
        run = target.begin(names)
        observed: dict[str, dict[str, int]] = {}

        def save(df: DataFrame, name: str, by: list[str] | None = None, layer: str = "gold",
                 bucket_by: tuple[int, list[str]] | None = None) -> None:
            if bucket_by:
                df = df.repartition(buckets, "customer_id")  # the buckets' own hash
            df, seen = quality.observe_table(name, df)
            marts.write_mart(df, target.staged(run, name, layer), by, as_tables, bucket_by)
            counts = quality.observed_counts(seen) if seen is not None else None
            if counts is not None:
                observed[name] = counts

        def staged(name: str, layer: str = "gold") -> DataFrame:
            return marts.read_mart(self.spark, target.staged(run, name, layer), as_tables)

        try:
            order = {"stg_subscriptions": ["customer_id", "month"], "stg_customers": ["customer_id"]}
            for name in silver:
                save(getattr(self, name), name, None, "silver", (buckets, order[name]) if buckets else None)
            built = self.with_bronze()  # nothing cached but the calendar's span
            built.__dict__.pop("calendar", None)
            for name in silver:
                built.__dict__[name] = staged(name, "silver")
            frames = {name: getattr(built, attr) for name, attr in MARTS.items()}  # plan on this thread
            # Movements are read one quarter at a time (close report, dashboards):
            # partition the mart by quarter so such reads prune to one folder.
            # Range-partitioning by (quarter, customer) first gives balanced tasks
            # that each write one or two quarter folders: few files, and a hot
            # quarter is split over many tasks instead of landing in one.
            frames["fct_arr_movements"] = frames["fct_arr_movements"].repartitionByRange(
                "fiscal_quarter", "customer_id")
            partitioned = {"fct_arr_movements": ["fiscal_quarter"]}
            with ThreadPoolExecutor(max_workers=max(1, concurrent_writes)) as pool:
                jobs = [pool.submit(save, frames[name], name, partitioned.get(name)) for name in MARTS]
                for job in jobs:
                    job.result()
            record = target.commit(run, names)
        except BaseException:
            target.discard(run)
            raise
        target.expire()
        done = self.with_bronze()
        done.__dict__.pop("calendar", None)
        done.observed = observed
        for name in silver:
            done.__dict__[name] = target.read(name, "silver", record)
        for name, attr in MARTS.items():
            done.__dict__[attr] = target.read(name, "gold", record)
        return done
