"""Hot keys: results stay exact and the plans combine map-side before shuffling."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import d
from quarterlens.operators import customers, staging, windows


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_invoice_id_dedup(spark):
    n = 3000
    base = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(
            F.concat(F.lit("INV-"), F.col("id").cast("string"))).alias("invoice_id"),
        (F.col("id") % 50).alias("customer_id"),
        F.date_add(F.lit(d("2023-02-01")), (F.col("id") % 27).cast("int")).alias("invoice_date"),
        F.lit(d("2023-02-01")).alias("period_month"),
        F.col("id").cast("decimal(12,2)").alias("amount"),
        F.struct(F.col("id").cast("double").alias("p")).alias("source_order"),
    ).repartition(6)
    out = staging.stage_invoices(base, ["source_order"])
    hot = out.where("invoice_id = 'HOT'").collect()
    # earliest date among HOT rows is 2023-02-01 (id % 27 == 0 and id % 3 == 0, i.e. id = 0)
    assert len(hot) == 1 and hot[0].invoice_date == d("2023-02-01")
    assert hot[0].amount == Decimal("0.00")
    assert out.count() == 1 + (n - n // 3)
    plan = _plan(out)
    # partial aggregate below the exchange: the hot id is reduced per map task
    assert plan.index("partial_min") > plan.index("Exchange hashpartitioning(invoice_id")


def test_hot_customer_activity_is_combined_map_side(spark):
    subs = spark.range(5000).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("customer_id"),
        F.add_months(F.lit(d("2020-01-01")), (F.col("id") % 60).cast("int")).alias("month"),
        F.when(F.col("id") == 4998, F.lit("churned")).otherwise(F.lit("active")).alias("status"),
    )
    act = customers.customer_activity(subs)
    hot = act.where("customer_id = 0").first()
    assert hot.first_active_month == d("2020-01-01")
    assert act.count() == 1 + 5000 - 1667
    plan = _plan(act)
    assert "partial_min" in plan and plan.index("partial_min") > plan.index("Exchange")


def _months_of_keys(spark):
    rows = [(k, d("2015-01-01").replace(year=2015 + i % 9, month=1 + i % 12) if i % 17 else None, (i * 7 + (k or 5)) % 4 or None, f"S{i % 50}")
            for k, n in ((None, 150), (1, 200), (2, 6), (3, 3)) for i in range(n)]
    return spark.createDataFrame(rows, "k BIGINT, t DATE, v INT, id STRING").repartition(5)


@pytest.mark.parametrize("hot_rows", [0, 100, 10**6])
def test_hot_keys_are_cut_and_the_others_are_not(spark, monkeypatch, hot_rows):
    monkeypatch.setattr(windows, "HOT_ROWS", hot_rows)
    df = _months_of_keys(spark)
    for shift in (windows.previous_value, windows.next_value):
        plain = shift(df, "k", "t", "v", "x", bucket=False, tie=["id"])
        safe = shift(df, "k", "t", "v", "x", tie=["id"])
        assert safe.columns == plain.columns
        assert sorted(map(str, safe.collect())) == sorted(map(str, plain.collect()))


def test_rows_of_keys_that_are_not_hot_are_dealt_once(spark):
    df = _months_of_keys(spark).groupBy("k", "id").agg(F.max("t").alias("t"), F.max("v").alias("v"))
    out = windows.previous_value(df, "k", "t", "v", "x", tie=["id"])
    out.collect()
    final = _plan(out).split("== Initial Plan ==")[0]
    # no bucket of a key, month and slice is made, sorted, handed over or joined
    assert "max_by" not in final and "SortMergeJoin" not in final and "__neighbour" not in final
    # an input that is partitioned by the key is dealt anew, so that a task's share follows its rows as they are now
    by_key = df.repartition("k").groupBy("k").agg(F.collect_list(F.struct("t", "v", "id")).alias("l")).selectExpr("k", "inline(l)")
    again = _plan(windows.previous_value(by_key, "k", "t", "v", "x", tie=["id"]))
    assert "hashpartitioning(__hash" in again.split("== Initial Plan ==")[-1]
