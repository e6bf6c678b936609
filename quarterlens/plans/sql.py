"""SQL access to the marts: temp views, and the model's standing questions.

``register_views`` exposes the silver and gold frames of a model under their
model names (``fct_revenue_waterfall``, ``fct_nrr_cohorts`` ...), so SQL written
for them works unchanged through ``spark.sql`` (with bound parameters such as
``:fq``).  ``ask`` answers the standing questions with the DataFrame operators.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarterlens.operators import reporting, semantic
from quarterlens.plans.model import RevenueModel

VIEWS = {
    "stg_customers": "stg_customers",
    "stg_subscriptions": "stg_subscriptions",
    "stg_invoices": "stg_invoices",
    "stg_usage_events": "stg_usage_events",
    "dim_fiscal_calendar": "calendar",
    "dim_customers": "dim_customers",
    "fct_arr_movements": "arr_movements",
    "fct_revenue_waterfall": "waterfall",
    "fct_nrr_cohorts": "nrr_cohorts",
}

def _of_quarter(df: DataFrame, fq: str) -> DataFrame:
    return df.where(F.col("fiscal_quarter") == F.lit(fq))


# The model's standing questions, answered by its own operators.
QUESTIONS: dict[str, Callable[..., DataFrame]] = {
    "waterfall_of_quarter": lambda m, fq: semantic.vq_quarter_waterfall(m.waterfall, fq),
    "growth_by_quarter": lambda m: semantic.vq_growth_trend(m.waterfall),
    "retention_by_cohort": lambda m: semantic.vq_nrr_by_cohort(m.nrr_cohorts),
    "movements_of_quarter": lambda m, fq: _of_quarter(reporting.movement_detail(m.arr_movements), fq)
    .orderBy(F.col("arr_delta").desc()),
    "headline_of_quarter": lambda m, fq: _of_quarter(reporting.close_summary(m.waterfall), fq),
    "retention_of_quarter": lambda m, fq: _of_quarter(reporting.close_nrr(m.nrr_cohorts), fq)
    .orderBy("cohort_quarter"),
}


def register_views(model: RevenueModel) -> list[str]:
    """Create or replace one temp view per mart; returns the view names."""
    for view, attr in VIEWS.items():
        getattr(model, attr).createOrReplaceTempView(view)
    return list(VIEWS)


def ask(model: RevenueModel, question: str, **params: str) -> DataFrame:
    """Answer one of ``QUESTIONS``; a quarter is passed as ``fq``."""
    return QUESTIONS[question](model, **params)
