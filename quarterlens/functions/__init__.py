"""Reusable Column expressions."""

from quarterlens.functions.columns import (  # noqa: F401
    classify_movement,
    fiscal_month_index,
    fiscal_quarter_label,
    fiscal_quarter_number,
    fiscal_year,
    month_start,
    nrr_band,
    pct,
    tier_arr,
)
