from quarterlens.operators import reporting
from quarterlens.plans.model import RevenueModel
from quarterlens.plans.sql import ask, register_views

SF = "/root/testdata/sf0.001"


def test_views_and_standing_questions(spark):
    m = RevenueModel.from_driver(spark, SF)
    assert "fct_revenue_waterfall" in register_views(m)
    fq = "FY1997-Q3"
    one = ask(m, "waterfall_of_quarter", fq=fq).collect()
    bound = spark.sql("SELECT * FROM fct_revenue_waterfall WHERE fiscal_quarter = :fq", args={"fq": fq})
    assert [tuple(r) for r in one] == [tuple(r) for r in bound.collect()] and len(one) == 1
    growth = ask(m, "growth_by_quarter").collect()
    assert [r.fiscal_quarter for r in growth] == sorted(r.fiscal_quarter for r in growth)
    want = {r.movement_type: r.arr_delta for r in reporting.movement_detail(m.arr_movements)
            .where(f"fiscal_quarter = '{fq}'").collect()}
    assert {r.movement_type: r.arr_delta for r in ask(m, "movements_of_quarter", fq=fq).collect()} == want
    assert ask(m, "retention_of_quarter", fq=fq).count() == m.nrr_cohorts.where(f"fiscal_quarter = '{fq}'").count()
    assert ask(m, "headline_of_quarter", fq="x' OR '1'='1").count() == 0
