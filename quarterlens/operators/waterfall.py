"""Quarterly revenue waterfall (ARR bridge) and the series derived from it.

After the first aggregation every frame here has one row per fiscal quarter,
so the unpartitioned quarter-ordered windows below run on a few dozen rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarterlens.constants import CHURN_SPIKE_THRESHOLD_PCT, MOVEMENT_TYPES
from quarterlens.functions.columns import pct
from quarterlens.operators.calendar import quarter_end_months



def _quarter_order():
    """Quarter-ordered window without partitions: only used on frames that
    have one row per fiscal quarter (a few dozen rows)."""
    return Window.orderBy("fiscal_quarter")


def quarterly_movements(movements: DataFrame) -> DataFrame:
    """Five conditional sums per fiscal_quarter (NULL quarter kept as a group)."""
    sums = [
        F.sum(F.when(F.col("movement_type") == F.lit(t), F.col("arr_delta"))
              .otherwise(F.lit(0))).cast("bigint").alias(f"{t}_arr")
        for t in MOVEMENT_TYPES
    ]
    return movements.groupBy("fiscal_quarter").agg(*sums)


def quarter_ending(monthly: DataFrame, cal: DataFrame) -> DataFrame:
    """ARR snapshot at the last calendar month of each fiscal quarter.

    The correlated "month = max(month) of its quarter" becomes a semi-join
    with the calendar's quarter-end months, then a sum.
    """
    ends = quarter_end_months(cal).select(
        F.col("fiscal_quarter").alias("__fq"), F.col("quarter_end_month").alias("__m"))
    at_end = monthly.join(
        ends,
        (F.col("month") == F.col("__m")) & (F.col("fiscal_quarter") == F.col("__fq")),
        "left_semi")
    return at_end.groupBy("fiscal_quarter").agg(
        F.sum("tier_arr").cast("bigint").alias("ending_arr"))


def revenue_waterfall(ending: DataFrame, moves: DataFrame) -> DataFrame:
    """Inner join of quarter-end ARR and movement sums, then LAG over quarters.

    The window runs after the join: a quarter without movements has no row
    and the next quarter's beginning ARR skips it (model behaviour).
    """
    return _waterfall_rows(ending.join(moves, "fiscal_quarter"))


def waterfall_from_months(months: DataFrame, cal: DataFrame) -> DataFrame:
    """The same waterfall in one pass over ``arr.with_movements`` rows.

    One map-side combined group-by per quarter gives the movement sums and the
    quarter-end ARR; quarters without a movement or without a quarter-end row
    have no row, as with the join.
    """
    ends = quarter_end_months(cal).select(
        F.col("fiscal_quarter").alias("__fq"), F.col("quarter_end_month").alias("__m"))
    marked = months.where(F.col("fiscal_quarter").isNotNull()).join(
        ends, (F.col("month") == F.col("__m")) & (F.col("fiscal_quarter") == F.col("__fq")), "left")
    delta = F.col("current_arr") - F.coalesce("prior_arr", F.lit(0))
    sums = [F.coalesce(F.sum(F.when(F.col("movement_type") == F.lit(t), delta)), F.lit(0))
            .cast("bigint").alias(f"{t}_arr") for t in MOVEMENT_TYPES]
    per = marked.groupBy("fiscal_quarter").agg(
        *sums, F.count("movement_type").alias("__moves"), F.count("__m").alias("__ends"),
        F.sum(F.when(F.col("__m").isNotNull(), F.col("current_arr"))).cast("bigint").alias("ending_arr"))
    return _waterfall_rows(per.where((F.col("__moves") > 0) & (F.col("__ends") > 0)))


def _waterfall_rows(joined: DataFrame) -> DataFrame:
    """LAG over the quarters and the columns that follow from it."""
    begin = F.lag("ending_arr").over(_quarter_order())
    return joined.select(
        "fiscal_quarter",
        begin.alias("beginning_arr"),
        "new_arr", "reactivation_arr", "expansion_arr", "contraction_arr", "churn_arr",
        "ending_arr",
        (F.col("ending_arr") - begin).alias("net_new_arr"),
        pct(F.col("ending_arr") - begin, begin).alias("qoq_growth_pct"),
    )


def qoq_series(waterfall: DataFrame) -> DataFrame:
    """Quarters with a QoQ value, and whether it is negative."""
    return waterfall.where(F.col("qoq_growth_pct").isNotNull()).select(
        "fiscal_quarter", "qoq_growth_pct",
        (F.col("qoq_growth_pct") < 0).alias("is_negative"))


def churn_spike(waterfall: DataFrame,
                threshold_pct: float = CHURN_SPIKE_THRESHOLD_PCT) -> DataFrame:
    """Churn magnitude per quarter vs the prior quarter; spike when up >= threshold."""
    churn = F.abs(F.col("churn_arr"))
    prev = F.lag(churn).over(_quarter_order())
    change = pct(churn - prev, prev)
    return waterfall.select(
        "fiscal_quarter",
        churn.alias("churn_abs"),
        prev.alias("prior_churn_abs"),
        change.alias("churn_change_pct"),
        F.coalesce(change >= F.lit(threshold_pct), F.lit(False)).alias("is_spike"),
    )


def churn_series(waterfall: DataFrame,
                 threshold_pct: float = CHURN_SPIKE_THRESHOLD_PCT) -> DataFrame:
    """abs(churn_arr) per quarter with an anomaly flag from the spike rule."""
    return churn_spike(waterfall, threshold_pct).select(
        "fiscal_quarter", "churn_abs", F.col("is_spike").alias("is_anomaly"))


def _year_earlier_label(fq: F.Column) -> F.Column:
    year = F.substring(fq, 3, 4).cast("int")
    return F.concat(F.lit("FY"), (year - 1).cast("string"), F.substring(fq, 7, 3))


def yoy_growth(waterfall: DataFrame) -> DataFrame:
    """Ending ARR vs the same fiscal quarter one year earlier (matched by label,
    so a missing quarter never shifts the comparison)."""
    cur = waterfall.select("fiscal_quarter", "ending_arr",
                           _year_earlier_label(F.col("fiscal_quarter")).alias("__prev_fq"))
    prev = waterfall.select(F.col("fiscal_quarter").alias("__prev_fq"),
                            F.col("ending_arr").alias("ending_arr_year_ago"))
    return cur.join(prev, "__prev_fq", "left").select(
        "fiscal_quarter", "ending_arr", "ending_arr_year_ago",
        pct(F.col("ending_arr") - F.col("ending_arr_year_ago"), F.col("ending_arr_year_ago"))
        .alias("yoy_growth_pct"))


def bridge_check(waterfall: DataFrame) -> DataFrame:
    """ending - (beginning + new + reactivation + expansion + contraction + churn).

    Contraction and churn are already negative, so all components are added.
    """
    bridge = (F.coalesce(F.col("beginning_arr"), F.lit(0)) + F.col("new_arr")
              + F.col("reactivation_arr") + F.col("expansion_arr")
              + F.col("contraction_arr") + F.col("churn_arr"))
    residual = F.col("ending_arr") - bridge
    return waterfall.select(
        "fiscal_quarter", "beginning_arr", "ending_arr",
        bridge.cast("bigint").alias("bridge_arr"),
        residual.cast("bigint").alias("residual_arr"),
        pct(residual, F.col("ending_arr")).alias("residual_pct"),
    )
