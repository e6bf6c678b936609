"""Column expressions shared by the operators.

Every function returns a ``Column`` built from Spark's own functions, so it
stays inside whole-stage code generation; nothing here runs Python per row.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from quarterlens.constants import (
    FISCAL_YEAR_START_MONTH,
    NRR_BAND_AT_RISK,
    NRR_BAND_CHURNING,
    NRR_BAND_STRONG,
    STATUS_CHURNED,
    TIER_ARR,
)


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def tier_arr(status: str | Column = "status", plan_tier: str | Column = "plan_tier",
             rates: Mapping[str, int] = TIER_ARR) -> Column:
    """Annual recurring revenue of one subscription month.

    churned -> 0; a known tier -> its rate; any other tier (unknown or NULL) -> 0.
    """
    status, plan_tier = _col(status), _col(plan_tier)
    expr = F.when(status == F.lit(STATUS_CHURNED), F.lit(0))
    for tier, rate in rates.items():
        expr = expr.when(plan_tier == F.lit(tier), F.lit(int(rate)))
    return expr.otherwise(F.lit(0)).cast("int")


def classify_movement(prior: str | Column = "prior_arr",
                      current: str | Column = "current_arr") -> Column:
    """Movement type of a change row; first matching rule wins, else NULL."""
    prior, current = _col(prior), _col(current)
    return (
        F.when(prior.isNull(), F.lit("new"))
        .when((prior == 0) & (current > 0), F.lit("reactivation"))
        .when((prior > 0) & (current > prior), F.lit("expansion"))
        .when((prior > 0) & (current > 0) & (current < prior), F.lit("contraction"))
        .when((prior > 0) & (current == 0), F.lit("churn"))
    )


def fiscal_month_index(month_date: str | Column,
                       fy_start_month: int = FISCAL_YEAR_START_MONTH) -> Column:
    """0-based month within the fiscal year (Feb = 0 ... Jan = 11 by default)."""
    return F.pmod(F.month(_col(month_date)) - F.lit(fy_start_month), F.lit(12))


def fiscal_year(month_date: str | Column,
                fy_start_month: int = FISCAL_YEAR_START_MONTH) -> Column:
    """Fiscal year named after the calendar year in which it ends."""
    d = _col(month_date)
    if fy_start_month == 1:
        return F.year(d)
    return F.when(F.month(d) >= fy_start_month, F.year(d) + 1).otherwise(F.year(d))


def fiscal_quarter_number(month_date: str | Column,
                          fy_start_month: int = FISCAL_YEAR_START_MONTH) -> Column:
    return (fiscal_month_index(month_date, fy_start_month) / 3).cast("int") + 1


def fiscal_quarter_label(month_date: str | Column,
                         fy_start_month: int = FISCAL_YEAR_START_MONTH) -> Column:
    """Label such as ``FY2026-Q3``; sorts correctly as a string for 4-digit years."""
    return F.concat(
        F.lit("FY"), fiscal_year(month_date, fy_start_month).cast("string"),
        F.lit("-Q"), fiscal_quarter_number(month_date, fy_start_month).cast("string"))


def pct(numerator: str | Column, denominator: str | Column, scale: int = 2) -> Column:
    """round(num / nullif(den, 0) * 100, scale) as double; NULL when den is 0 or NULL."""
    num = _col(numerator).cast("double")
    den = F.nullif(_col(denominator).cast("double"), F.lit(0.0))
    return F.round(num / den * F.lit(100.0), scale)


def nrr_band(nrr_pct: str | Column = "nrr_pct") -> Column:
    """Strong / At Risk / Churning; NULL NRR gets no band."""
    v = _col(nrr_pct)
    return (
        F.when(v >= F.lit(NRR_BAND_STRONG[1]), F.lit(NRR_BAND_STRONG[0]))
        .when(v >= F.lit(NRR_BAND_AT_RISK[1]), F.lit(NRR_BAND_AT_RISK[0]))
        .when(v.isNotNull(), F.lit(NRR_BAND_CHURNING))
    )


def month_start(ts: str | Column) -> Column:
    """First day of the month of a date or timestamp, as a DATE."""
    return F.trunc(_col(ts).cast("date"), "MM")
