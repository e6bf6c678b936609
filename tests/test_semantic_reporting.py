import os
import tempfile
import warnings

import pytest
from pyspark.sql import functions as F

from quarterlens.operators import reporting, semantic
from quarterlens.plans.model import RevenueModel
from quarterlens.sources import marts

SF = "/root/testdata/sf0.001"


def test_synonyms_resolve_metric_before_fact():
    assert semantic.resolve("ARR")[1].name == "ending_arr_metric"
    assert semantic.resolve("growth")[1].name == "net_new_arr_metric"
    assert semantic.resolve("closing ARR")[1].name == "ending_arr"
    assert semantic.resolve("NRR")[1].name == "avg_nrr_pct"
    assert semantic.resolve("bookings")[1].name == "new_arr"
    with pytest.raises(KeyError):
        semantic.resolve("gross margin")
    assert semantic.resolve_dimension("period", semantic.NRR_COHORTS) == "fiscal_quarter"
    assert semantic.resolve_dimension("cohort", semantic.NRR_COHORTS) == "cohort_quarter"


def test_metric_query_and_semi_additive_warning(spark):
    m = RevenueModel.from_driver(spark, SF)
    frames = {"revenue_waterfall": m.waterfall, "nrr_cohorts": m.nrr_cohorts}
    by_q = semantic.metric(frames, ["churn", "expansion"], by=["quarter"])
    assert by_q.count() == m.waterfall.count()
    one = semantic.metric(frames, "lost revenue", where={"FQ": "FY1997-Q1"}).first()[0]
    assert one == m.waterfall.where("fiscal_quarter = 'FY1997-Q1'").first().churn_arr
    with warnings.catch_warnings(record=True) as w:
        warnings.simplefilter("always")
        semantic.metric(frames, "total ARR")
        assert any("semi-additive" in str(x.message) for x in w)
    with pytest.raises(ValueError):
        semantic.metric(frames, ["ARR", "NRR"])


def test_arr_bridge_long_form(spark):
    m = RevenueModel.from_driver(spark, SF)
    br = reporting.arr_bridge(m.waterfall).where("fiscal_quarter = 'FY1995-Q4'") \
        .orderBy("position").collect()
    assert [r.component for r in br] == ["Beginning ARR", "New", "Reactivation", "Expansion",
                                         "Contraction", "Churn", "Ending ARR"]
    assert br[0].arr == 0 and br[0].measure == "absolute" and br[1].measure == "relative"


def test_close_report_and_sinks(spark):
    m = RevenueModel.from_driver(spark, SF)
    with pytest.raises(KeyError):
        m.close_report("FY1800-Q1")
    tabs = m.close_report("FY1997-Q3")
    summary = tabs["summary"].collect()
    assert len(summary) == 1 and summary[0].beginning_arr is not None
    out = tempfile.mkdtemp(prefix="ql-close-")
    paths = marts.write_close_report(m.close_report(), out)
    assert set(paths) == {"summary", "movements", "nrr"}
    back = spark.read.parquet(paths["summary"]).where(F.col("fiscal_quarter") == "FY1997-Q3")
    assert back.count() == 1
    assert os.path.isdir(os.path.join(paths["summary"], "fiscal_quarter=FY1997-Q3"))
    # write_mart overwrites the whole mart
    p = marts.mart_path(out, "fct_revenue_waterfall")
    marts.write_mart(m.waterfall, p)
    marts.write_mart(m.waterfall, p)
    assert marts.read_mart(spark, p).count() == m.waterfall.count()


def test_build_writes_gold_and_reads_back(spark):
    m = RevenueModel.from_driver(spark, SF)
    root = tempfile.mkdtemp(prefix="ql-gold-")
    built = m.build(root)
    store = marts.MartStore(spark, root)
    assert set(store.record()["marts"]) == {"silver/stg_subscriptions"} | {f"gold/{name}" for name in (
        "dim_fiscal_calendar", "dim_customers", "fct_arr_movements", "fct_revenue_waterfall", "fct_nrr_cohorts")}
    assert sorted(store.read("dim_customers").collect()) == sorted(m.dim_customers.collect())
    assert sorted(built.waterfall.collect()) == sorted(m.waterfall.collect())
    assert sorted(built.nrr_cohorts.collect()) == sorted(m.nrr_cohorts.collect())


def test_batch_job_end_to_end(spark):
    from quarterlens.plans import job
    out = tempfile.mkdtemp(prefix="ql-job-")
    assert job.main(["--sf-dir", SF, "--out", out]) == 0
    assert marts.MartStore(spark, out).read("dq_results").count() == 23
    assert job.main(["--sf-dir", SF, "--out", out, "--quarter", "FY1997-Q3"]) == 0
    assert marts.MartStore(spark, out).record()["version"] == 4
    assert os.path.isdir(os.path.join(out, "gold", "close_report", "summary"))


def test_movements_mart_prunes_by_quarter(spark):
    m = RevenueModel.from_driver(spark, SF)
    built = m.build(tempfile.mkdtemp(prefix="ql-part-"))
    one = built.arr_movements.where(F.col("fiscal_quarter") == "FY1997-Q3")
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(fiscal_quarter" in plan
    assert one.count() == m.arr_movements.where(F.col("fiscal_quarter") == "FY1997-Q3").count()
    # rows outside the calendar keep a NULL quarter through the partitioned write
    assert built.arr_movements.where(F.col("fiscal_quarter").isNull()).count() == \
        m.arr_movements.where(F.col("fiscal_quarter").isNull()).count()
    cols = sorted(built.arr_movements.columns)
    assert cols == sorted(m.arr_movements.columns)


def test_build_into_a_catalog_schema(spark):
    m = RevenueModel.from_driver(spark, SF)
    built = m.build("ql_test", as_tables=True)
    assert {t.name for t in spark.catalog.listTables("ql_test_silver")} >= {"stg_subscriptions"}
    assert {t.name for t in spark.catalog.listTables("ql_test_gold")} >= {"fct_nrr_cohorts"}
    assert sorted(built.waterfall.collect()) == sorted(m.waterfall.collect())
    assert built.cohort_quarters.count() == m.cohort_quarters.count()


def test_facts_add_up_only_where_they_may(spark):
    frames = {"revenue_waterfall": spark.createDataFrame(
        [("FY1", 100, 5.0, 7), ("FY2", 200, 6.0, 8)], "fiscal_quarter STRING, ending_arr INT, qoq_growth_pct DOUBLE, churn_arr INT")}
    for fact in ("closing ARR", "growth rate"):
        with pytest.raises(ValueError):
            semantic.metric(frames, fact)
    assert semantic.metric(frames, "lost ARR").first()[0] == 15
    assert semantic.metric(frames, ["closing ARR", "growth rate"], where={"FQ": "FY2"}).first()[:] == (200, 6.0)
