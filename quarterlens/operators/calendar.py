"""Fiscal calendar dimension: one row per month.

Columns: month_date, fiscal_year, fiscal_quarter, fiscal_quarter_number,
calendar_year, calendar_month.

``fiscal_calendar`` generates a fixed span (the original model: 36 months
from 2023-02-01).  ``fiscal_calendar_for`` derives the span from data: every
fiscal quarter that holds an observed month, whole, lazily, so the calendar
follows the tables it labels and no row is left without a quarter.  Either way
the result has one row per month of a date range; Spark sees its size and
chooses the join.
"""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarterlens.constants import (
    DEFAULT_CALENDAR_MONTHS,
    DEFAULT_CALENDAR_START,
    FISCAL_YEAR_START_MONTH,
)
from quarterlens.functions.columns import (
    fiscal_month_index,
    fiscal_quarter_label,
    fiscal_quarter_number,
    fiscal_year,
    month_start,
)


def _label(months: DataFrame, fy_start_month: int) -> DataFrame:
    d = F.col("month_date")
    return months.select(
        d.alias("month_date"),
        fiscal_year(d, fy_start_month).cast("int").alias("fiscal_year"),
        fiscal_quarter_label(d, fy_start_month).alias("fiscal_quarter"),
        fiscal_quarter_number(d, fy_start_month).cast("int").alias("fiscal_quarter_number"),
        F.year(d).cast("int").alias("calendar_year"),
        F.month(d).cast("int").alias("calendar_month"),
    )


def fiscal_calendar(spark: SparkSession, start: str = DEFAULT_CALENDAR_START,
                    months: int = DEFAULT_CALENDAR_MONTHS,
                    fy_start_month: int = FISCAL_YEAR_START_MONTH) -> DataFrame:
    """``months`` consecutive months from ``start`` (0-based offsets)."""
    first = datetime.date.fromisoformat(start)
    index = F.col("id") + F.lit(first.year * 12 + first.month - 1)
    gen = spark.range(0, max(months, 0), 1, 1).select(_month_of(index).alias("month_date"))
    return _label(gen, fy_start_month)


def _month_of(index: Column) -> Column:
    """The first day of the month with that index (12 * year + month - 1)."""
    return F.make_date(F.floor(index / 12).cast("int"), (F.pmod(index, F.lit(12)) + 1).cast("int"), F.lit(1))


def fiscal_calendar_for(df: DataFrame, date_col: str | Column,
                        fy_start_month: int = FISCAL_YEAR_START_MONTH) -> DataFrame:
    """Calendar of every fiscal quarter that min..max of ``date_col`` touches.

    First month: the start of the earliest month's quarter.  Last month: the
    end of the latest month's quarter.
    """
    c = F.col(date_col) if isinstance(date_col, str) else date_col
    span = df.agg(month_start(F.min(c)).alias("lo"), month_start(F.max(c)).alias("hi"))
    first = F.add_months("lo", (-(fiscal_month_index("lo", fy_start_month) % 3)).cast("int"))
    last = F.add_months("hi", (2 - fiscal_month_index("hi", fy_start_month) % 3).cast("int"))
    months = span.select(first.alias("first"), last.alias("last")).select(
        F.explode(
            F.when(F.col("last") >= F.col("first"),
                   F.sequence("first", "last", F.expr("interval 1 month")))
            .otherwise(F.array().cast("array<date>"))
        ).alias("month_date"))
    return _label(months, fy_start_month)


def month_range(df: DataFrame, date_col: str | Column
                ) -> tuple[datetime.date | None, datetime.date | None]:
    """First and last month of ``date_col``: one two-value aggregate."""
    c = F.col(date_col) if isinstance(date_col, str) else date_col
    lo, hi = df.agg(month_start(F.min(c)), month_start(F.max(c))).first()
    return lo, hi


def calendar_span(df: DataFrame | None, date_col: str | Column | None = None,
                  fy_start_month: int = FISCAL_YEAR_START_MONTH,
                  months_seen: tuple[datetime.date | None, datetime.date | None] | None = None
                  ) -> tuple[str, int]:
    """(first month, month count) of the fiscal quarters that the data touches.

    Same rule as ``fiscal_calendar_for`` but resolved with one two-value
    aggregate (or a given ``months_seen`` range), so the calendar can be
    generated as a tiny ``range`` and the plans that broadcast it carry no
    scan of the data.
    """
    lo, hi = months_seen if months_seen is not None else month_range(df, date_col)
    if lo is None:
        return DEFAULT_CALENDAR_START, 0
    first = lo.year * 12 + lo.month - 1 - (lo.month - fy_start_month) % 12 % 3
    last = hi.year * 12 + hi.month - 1 + 2 - (hi.month - fy_start_month) % 12 % 3
    return f"{first // 12:04d}-{first % 12 + 1:02d}-01", last - first + 1


def quarter_labels(start: str, months: int, fy_start_month: int = FISCAL_YEAR_START_MONTH) -> list[str]:
    """The fiscal quarter labels of a calendar, in order, by the calendar rule alone."""
    first = datetime.date.fromisoformat(start)
    index = first.year * 12 + first.month - fy_start_month  # months since the start of a fiscal year
    # A fiscal year that does not begin in January is named after its end.
    named = 1 if fy_start_month > 1 else 0
    return list(dict.fromkeys(f"FY{k // 12 + named}-Q{k % 12 // 3 + 1}" for k in range(index, index + months)))


def quarter_end_months(cal: DataFrame) -> DataFrame:
    """(fiscal_quarter, quarter_end_month): the calendar's last month of each quarter."""
    return cal.groupBy("fiscal_quarter").agg(F.max("month_date").alias("quarter_end_month"))
