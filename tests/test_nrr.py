from conftest import SF_MID, d, subs_frame
from quarterlens.operators import arr, calendar, customers, nrr, staging
from quarterlens.plans.model import RevenueModel

CUST_SCHEMA = "customer_id BIGINT, signup_date DATE, region STRING, initial_plan_tier STRING"


def test_partial_quarter_cohort_formula_vs_quarter_end(spark):
    cal = calendar.fiscal_calendar(spark)
    rows, custs = [], []
    for cid, start in [(1, 2), (2, 3), (3, 4)]:  # signups in months 1, 2, 3 of FY2024-Q1
        custs.append((cid, d(f"2023-{start:02d}-10"), "NA", "Starter"))
        rows += [(cid, f"2023-{m:02d}-01", "Starter", "active") for m in range(start, 8)]
    subs = staging.stage_subscriptions(subs_frame(spark, rows))
    dim = customers.dim_customers(
        staging.stage_customers(spark.createDataFrame(custs, CUST_SCHEMA)), subs, cal)
    monthly = arr.monthly_arr(subs, cal)
    cohort_q = nrr.cohort_quarters(dim, nrr.customer_quarters(monthly, cal))
    assert nrr.cohort_members(cohort_q).count() == 3
    formula = {r.fiscal_quarter: r.nrr_pct
               for r in nrr.nrr_cohorts(nrr.cohort_forward(cohort_q)).collect()}
    qend = {r.fiscal_quarter: r.nrr_pct_qend
            for r in nrr.nrr_cohorts_qend(cohort_q).collect()}
    assert formula == {"FY2024-Q1": 100.0, "FY2024-Q2": 150.0}
    assert qend == {"FY2024-Q1": 100.0, "FY2024-Q2": 100.0}


def test_fixture_nrr_numbers(spark):
    m = RevenueModel.from_driver(spark, SF_MID)
    assert m.nrr_cohorts.count() == 363
    first = [r.nrr_pct for r in m.nrr_cohorts.where("cohort_quarter = 'FY1996-Q1'")
             .orderBy("fiscal_quarter").limit(4).collect()]
    assert first == [100.0, 137.71, 150.47, 151.95]
    qend = [r.nrr_pct_qend for r in m.nrr_cohorts_qend.where("cohort_quarter = 'FY1996-Q1'")
            .orderBy("fiscal_quarter").limit(4).collect()]
    assert qend == [100.0, 100.34, 109.08, 110.92]
    at_start = m.nrr_cohorts.where("cohort_quarter = fiscal_quarter").collect()
    assert len(at_start) == 21 and all(r.nrr_pct == 100.0 for r in at_start)


def test_nrr_reporting_views(spark):
    m = RevenueModel.from_driver(spark, "/root/testdata/sf0.001")
    bands = {r.nrr_band for r in nrr.nrr_bands(m.nrr_cohorts).collect()}
    assert bands <= {"Strong", "At Risk", "Churning", None}
    latest = nrr.nrr_latest(m.nrr_cohorts).collect()
    top = m.nrr_cohorts.agg({"fiscal_quarter": "max"}).first()[0]
    assert latest and all(r.fiscal_quarter == top for r in latest)
    trend = nrr.nrr_trend(m.nrr_cohorts).where("quarter_index = 1").collect()
    assert all(r.cohort_quarter == r.fiscal_quarter for r in trend)
    quarters = m.calendar_quarters()
    mat = nrr.nrr_matrix(m.nrr_cohorts, quarters)
    assert mat.columns == ["cohort_quarter"] + quarters
    assert mat.count() == m.nrr_cohorts.select("cohort_quarter").distinct().count()
