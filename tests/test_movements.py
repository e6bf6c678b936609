import random

import pytest
from pyspark.sql import functions as F

from conftest import SF_MID, d, subs_frame
from quarterlens.operators import arr, calendar, staging
from quarterlens.operators.windows import next_value, previous_value
from quarterlens.sources.driver import monthly_snapshots
from quarterlens.plans.model import RevenueModel


def movements(spark, rows, skew_safe=False):
    cal = calendar.fiscal_calendar(spark)
    monthly = arr.monthly_arr(staging.stage_subscriptions(subs_frame(spark, rows)), cal)
    out = arr.arr_movements(monthly, skew_safe=skew_safe).orderBy("customer_id", "month")
    return [(r.month.isoformat()[:7], r.movement_type, r.prior_arr, r.current_arr, r.arr_delta)
            for r in out.collect()]


@pytest.mark.parametrize("skew_safe", [False, True])
def test_all_five_movement_types(spark, skew_safe):
    rows = [(1, "2023-02-01", "Starter", "active"), (1, "2023-03-01", "Growth", "active"),
            (1, "2023-04-01", "Starter", "active"), (1, "2023-05-01", "Starter", "churned"),
            (1, "2023-07-01", "Starter", "active")]
    assert movements(spark, rows, skew_safe) == [
        ("2023-02", "new", None, 2400, 2400),
        ("2023-03", "expansion", 2400, 14400, 12000),
        ("2023-04", "contraction", 14400, 2400, -12000),
        ("2023-05", "churn", 2400, 0, -2400),
        ("2023-07", "reactivation", 0, 2400, 2400),
    ]


def test_missing_first_tier_delays_new(spark):
    rows = [(1, "2023-02-01", None, "active"), (1, "2023-03-01", "Growth", "active")]
    assert movements(spark, rows) == [("2023-03", "new", None, 14400, 14400)]


def test_missing_churn_row_hides_churn(spark):
    rows = [(1, "2023-02-01", "Growth", "active"), (1, "2023-03-01", None, "churned"),
            (1, "2023-05-01", "Starter", "active")]
    assert movements(spark, rows) == [("2023-02", "new", None, 14400, 14400),
                                      ("2023-05", "contraction", 14400, 2400, -12000)]


def test_first_row_churned_is_zero_delta_new(spark):
    assert movements(spark, [(1, "2023-02-01", "Starter", "churned")]) == [
        ("2023-02", "new", None, 0, 0)]


def test_unknown_tier_reads_as_churn(spark):
    rows = [(1, "2023-02-01", "Starter", "active"), (1, "2023-03-01", "Platinum", "active")]
    assert movements(spark, rows)[-1] == ("2023-03", "churn", 2400, 0, -2400)


def test_empty_string_tier_is_not_missing(spark):
    rows = [(1, "2023-02-01", "", "active")]
    stg = staging.stage_subscriptions(subs_frame(spark, rows))
    assert stg.first().is_missing_tier is False
    assert movements(spark, rows) == [("2023-02", "new", None, 0, 0)]


def test_silent_gap_is_not_churn(spark):
    rows = [(1, "2023-02-01", "Growth", "active"), (1, "2023-09-01", "Growth", "active")]
    assert movements(spark, rows) == [("2023-02", "new", None, 14400, 14400)]


def test_month_outside_calendar_keeps_null_quarter(spark):
    cal = calendar.fiscal_calendar(spark)
    rows = [(1, "2022-12-01", "Starter", "active"), (1, "2023-02-01", "Growth", "active")]
    monthly = arr.monthly_arr(staging.stage_subscriptions(subs_frame(spark, rows)), cal)
    got = {r.month.isoformat(): r.fiscal_quarter for r in arr.arr_movements(monthly).collect()}
    assert got == {"2022-12-01": None, "2023-02-01": "FY2024-Q1"}


def _lag_both_ways(spark, rows):
    df = spark.createDataFrame(rows, "k BIGINT, t DATE, v INT")
    plain = previous_value(df, "k", "t", "v", "p", bucket=False)
    safe = previous_value(df, "k", "t", "v", "p")
    lead_plain = next_value(df, "k", "t", "v", "n", bucket=False)
    lead_safe = next_value(df, "k", "t", "v", "n")
    return (sorted(plain.collect()), sorted(safe.collect()),
            sorted(lead_plain.collect()), sorted(lead_safe.collect()))


def test_skew_safe_lag_equals_plain_window_with_hot_key(spark):
    rnd = random.Random(7)
    rows = []
    months = [d(f"{y}-{m:02d}-01") for y in range(1995, 2003) for m in range(1, 13)]
    # one hot key owns most rows, with gaps and empty years; others are sparse
    for t in rnd.sample(months, 70):
        rows.append((0, t, rnd.choice([0, 2400, 14400, None])))
    for k in range(1, 40):
        for t in rnd.sample(months, rnd.randint(1, 6)):
            rows.append((k, t, rnd.choice([0, 2400, 72000])))
    a, b, c, e = _lag_both_ways(spark, rows)
    assert a == b
    assert c == e


def test_skew_safe_lag_with_null_keys_null_months_and_duplicates(spark):
    rnd = random.Random(11)
    months = [None, d("2023-11-01"), d("2023-12-01"), d("2024-01-01"), d("2024-02-01")]
    rows = [(rnd.choice([None, 1, 2]), rnd.choice(months), rnd.choice([0, 2400, 14400, None]), f"S{i}")
            for i in range(300)]
    rows += rows[:40]  # whole rows repeated
    df = spark.createDataFrame(rows, "k BIGINT, t DATE, v INT, id STRING")
    for shift in (previous_value, next_value):
        plain = shift(df, "k", "t", "v", "x", bucket=False, tie=["id"])
        safe = shift(df, "k", "t", "v", "x", tie=["id"])
        assert sorted(map(str, plain.collect())) == sorted(map(str, safe.collect()))
    # a NULL customer's December precedes its January, and a NULL month comes last
    one = spark.createDataFrame([(None, d("2023-12-01"), 1), (None, d("2024-01-01"), 2), (None, None, 3)],
                                "k BIGINT, t DATE, v INT")
    assert {r.v: r.p for r in previous_value(one, "k", "t", "v", "p").collect()} == {1: None, 2: 1, 3: 2}


def test_snapshots_leave_the_log_as_it_is(spark):
    log = spark.createDataFrame(
        [(c, d(m), t, s) for c in range(60) for m, t, s in (
            ("2023-01-01", "Pro", "active"), ("2023-04-01", "Growth", "churned"), ("2023-07-01", "Growth", "active"))],
        "customer_id BIGINT, change_month DATE, tier STRING, status STRING")
    snap = monthly_snapshots(log, "2023-08-01")
    assert snap.where("plan_tier IS NULL").count() == 0 and snap.where("plan_tier = 'Pro'").count() == 180
    assert snap.count() == 60 * (3 + 1 + 2)
    early = monthly_snapshots(log, "2023-02-01")  # a period end before the last change
    assert early.count() == 120 and early.agg({"month": "max"}).first()[0] == d("2023-02-01")
    assert monthly_snapshots(log.unionAll(log)).where("customer_id = 0").count() >= 6


def test_skew_safe_movements_match_plain_on_fixture(spark):
    plain = RevenueModel.from_driver(spark, SF_MID, skew_safe=False).arr_movements
    safe = RevenueModel.from_driver(spark, SF_MID, skew_safe=True).arr_movements
    assert plain.count() == safe.count() == 9253
    assert plain.exceptAll(safe).count() == 0


def test_movement_types_partition_change_rows_and_deltas_telescope(spark):
    m = RevenueModel.from_driver(spark, "/root/testdata/sf0.001")
    mov = m.arr_movements
    assert mov.where(F.col("movement_type").isNull()).count() == 0
    # sum of deltas per customer = ARR of the customer's last known month
    last = m.monthly_arr.groupBy("customer_id").agg(F.max_by("tier_arr", "month").alias("last"))
    sums = mov.groupBy("customer_id").agg(F.sum("arr_delta").alias("s"))
    bad = last.join(sums, "customer_id", "full").where(
        ~F.coalesce(F.col("s"), F.lit(0)).eqNullSafe(F.coalesce(F.col("last"), F.lit(0))))
    assert bad.count() == 0
