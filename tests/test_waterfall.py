from pyspark.sql import functions as F

from conftest import SF_MID, subs_frame
from quarterlens.operators import arr, calendar, staging, waterfall
from quarterlens.plans.model import RevenueModel
from quarterlens.sources import driver


def _wf(spark, rows):
    cal = calendar.fiscal_calendar(spark)
    monthly = arr.monthly_arr(staging.stage_subscriptions(subs_frame(spark, rows)), cal)
    moves = waterfall.quarterly_movements(arr.arr_movements(monthly))
    ending = waterfall.quarter_ending(monthly, cal)
    return waterfall.revenue_waterfall(ending, moves)


def test_quiet_quarter_is_absent_and_beginning_skips_it(spark):
    rows = [(1, f"2023-{m:02d}-01", "Starter", "active") for m in range(2, 11)]
    rows += [(2, f"2023-{m:02d}-01", "Starter", "active") for m in range(8, 11)]
    wf = {r.fiscal_quarter: r for r in _wf(spark, rows).collect()}
    assert set(wf) == {"FY2024-Q1", "FY2024-Q3"}
    q1, q3 = wf["FY2024-Q1"], wf["FY2024-Q3"]
    assert (q1.beginning_arr, q1.ending_arr, q1.new_arr) == (None, 2400, 2400)
    assert (q3.beginning_arr, q3.ending_arr, q3.net_new_arr) == (2400, 4800, 2400)
    assert q3.qoq_growth_pct == 100.0


def test_flagship_first_rows_match_fixture_numbers(spark):
    wf = RevenueModel.from_driver(spark, SF_MID).waterfall.orderBy("fiscal_quarter")
    rows = [tuple(r) for r in wf.limit(4).collect()]
    # January 1995, the first month of orders, belongs to the quarter before
    assert rows[0][:3] == ("FY1995-Q4", None, rows[0][7])
    rows = rows[1:]
    assert rows[0][:8] == ("FY1996-Q1", 2361600, 3794400, 122400, 223200, -712800, -196800, 5551200)
    assert rows[1] == ("FY1996-Q2", 5551200, 3331200, 369600, 1670400, -1495200, -304800,
                       9120000, 3568800, 64.29)
    assert rows[2][-1] == 36.45
    assert wf.count() == 27


def test_bridge_residual(spark):
    m = RevenueModel.from_driver(spark, SF_MID)
    chk = waterfall.bridge_check(m.waterfall).orderBy("fiscal_quarter").collect()
    after_first = chk[1:]
    worst = max(after_first, key=lambda r: abs(r.residual_arr))
    assert abs(worst.residual_arr) == 297600


def test_bridge_residual_is_zero_without_missing_tiers(spark):
    t = driver.DriverTables(spark, SF_MID)
    full = driver.bronze_subscriptions(t, missing_tiers=False)
    base = RevenueModel.from_driver(spark, SF_MID)
    m = base.with_bronze(raw_subscriptions=full)
    chk = waterfall.bridge_check(m.waterfall).orderBy("fiscal_quarter").collect()
    assert all(r.residual_arr == 0 for r in chk)


def test_yoy_matches_by_label_and_churn_spike(spark):
    m = RevenueModel.from_driver(spark, SF_MID)
    yoy = {r.fiscal_quarter: r for r in waterfall.yoy_growth(m.waterfall).collect()}
    assert yoy["FY1995-Q4"].ending_arr_year_ago is None
    assert yoy["FY1997-Q1"].ending_arr_year_ago == 5551200
    spikes = waterfall.churn_spike(m.waterfall).where(F.col("is_spike")).count()
    assert spikes > 0
    series = waterfall.churn_series(m.waterfall).collect()
    assert all(r.churn_abs >= 0 for r in series)


def test_generic_constructor_with_skew_safe_lag_matches(spark):
    t = driver.DriverTables(spark, "/root/testdata/sf0.001")
    bronze = driver.read_bronze(t)  # period end from a scalar subquery here
    orders = t("orders", "o_orderdate")
    generic = RevenueModel(spark, bronze, calendar_source=orders,
                           calendar_column="o_orderdate")  # skew-safe by default
    assert generic.skew_safe
    ref = RevenueModel.from_driver(spark, "/root/testdata/sf0.001")
    assert sorted(generic.waterfall.collect()) == sorted(ref.waterfall.collect())
    assert sorted(generic.nrr_cohorts.collect()) == sorted(ref.nrr_cohorts.collect())


def test_one_pass_waterfall_equals_the_joined_one(spark):
    m = RevenueModel.from_driver(spark, SF_MID)
    joined = waterfall.revenue_waterfall(m.quarter_ending, m.quarterly_movements)
    assert sorted(joined.collect()) == sorted(m.waterfall.collect())
    plan = m.waterfall._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Generate explode") == 1 and plan.count("lag(change_month") + plan.count("lead(") <= 1


def test_real_bronze_tables_give_the_same_marts(spark, tmp_path):
    from quarterlens.sources import bronze
    ref = RevenueModel.from_driver(spark, "/root/testdata/sf0.001")
    bronze.write_bronze_tables({n: ref._raw(n) for n in bronze.BRONZE_SCHEMAS}, str(tmp_path / "bronze"))
    m = RevenueModel.from_bronze(spark, str(tmp_path / "bronze"))
    assert sorted(m.waterfall.collect()) == sorted(ref.waterfall.collect())
    checks = m.data_quality().collect()
    assert len(checks) == 23 and all(r.failures == 0 for r in checks)
    from quarterlens.plans import job
    assert job.main(["--bronze", str(tmp_path / "bronze"), "--out", str(tmp_path / "out")]) == 0
    # text files, read with the declared schema
    m.raw_customers.write.option("header", "true").csv(str(tmp_path / "csv" / "raw_customers"))
    for n in set(bronze.BRONZE_SCHEMAS) - {"raw_customers"}:
        m._raw(n).write.option("header", "true").csv(str(tmp_path / "csv" / n))
    text = RevenueModel.from_bronze(spark, str(tmp_path / "csv"), "csv")
    assert sorted(text.waterfall.collect()) == sorted(ref.waterfall.collect())
