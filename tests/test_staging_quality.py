from decimal import Decimal

from pyspark.sql import functions as F

from conftest import SF_MID, d
from quarterlens.operators import quality, staging
from quarterlens.plans.model import RevenueModel

INV_SCHEMA = ("invoice_id STRING, customer_id BIGINT, invoice_date DATE, period_month DATE, "
              "amount DECIMAL(12,2), source_order STRUCT<p: DOUBLE, q: BIGINT>")


def test_duplicate_invoices_keep_first_nulls_last(spark):
    rows = [
        ("A", 1, d("2023-02-05"), d("2023-02-01"), Decimal("10.00"), (1.0, 1)),
        ("A", 1, None, d("2023-02-01"), Decimal("11.00"), (0.5, 1)),
        ("A", 1, d("2023-02-03"), d("2023-02-01"), Decimal("12.00"), (9.0, 1)),
        ("B", 2, None, d("2023-02-01"), Decimal("20.00"), (2.0, 1)),
        ("B", 2, None, d("2023-02-01"), Decimal("21.00"), (1.0, 1)),
        ("C", 3, d("2023-02-03"), d("2023-02-01"), Decimal("30.00"), (1.0, 2)),
        ("C", 3, d("2023-02-03"), d("2023-02-01"), Decimal("30.00"), (1.0, 2)),
    ]
    raw = spark.createDataFrame(rows, INV_SCHEMA)
    out = {r.invoice_id: r for r in staging.stage_invoices(raw, ["source_order"]).collect()}
    assert out["A"].invoice_date == d("2023-02-03") and out["A"].amount == Decimal("12.00")
    assert out["B"].amount == Decimal("21.00")  # both dates NULL: tie-break decides
    assert out["C"].amount == Decimal("30.00")
    assert len(out) == 3
    # idempotent
    again = staging.stage_invoices(staging.stage_invoices(raw, ["source_order"]))
    assert sorted(again.collect()) == sorted(staging.stage_invoices(raw, ["source_order"])
                                             .collect())


def test_late_invoice_flagged(spark):
    rows = [("L", 1, d("2023-03-07"), d("2023-02-01"), Decimal("1.00"), (1.0, 1)),
            ("OK", 1, d("2023-02-28"), d("2023-02-01"), Decimal("1.00"), (1.0, 1))]
    inv = staging.stage_invoices(spark.createDataFrame(rows, INV_SCHEMA), ["source_order"])
    late = quality.late_invoices(inv).collect()
    assert [(r.invoice_id, r.days_late) for r in late] == [("L", 7)]


def test_stage_customers_trims_region_only(spark):
    raw = spark.createDataFrame([(1, "2023-02-05", "  EMEA ", " Growth ")],
                                "customer_id BIGINT, signup_date STRING, region STRING, "
                                "initial_plan_tier STRING")
    r = staging.stage_customers(raw).first()
    assert r.region == "EMEA" and r.initial_plan_tier == " Growth "
    assert r.signup_date == d("2023-02-05")


def test_fixture_counts(spark):
    m = RevenueModel.from_driver(spark, SF_MID)
    assert m.raw_invoices.count() == 60000
    assert m.stg_invoices.count() == 45832
    audit = quality.missing_tier_audit(m.stg_subscriptions).first()
    assert (audit.total_rows, audit.missing_tier_rows) == (99400, 1029)
    dim = m.dim_customers
    assert dim.count() == 1500
    assert dim.where(F.col("signup_fiscal_quarter").isNull() & F.col("signup_date").isNotNull()).count() == 0


def test_declared_checks_pass_on_fixture(spark):
    m = RevenueModel.from_driver(spark, "/root/testdata/sf0.001")
    res = m.data_quality().collect()
    assert len(res) == 23
    assert {r.check_name for r in res} == {"not_null", "unique", "accepted_values"}
    assert all(r.failures == 0 for r in res), [r for r in res if r.failures]


def test_checks_detect_failures(spark):
    df = spark.createDataFrame([(1, "active"), (1, "paused"), (None, "gone"), (2, None)],
                               "customer_id BIGINT, status STRING")
    nn = quality.not_null("t", df, ["customer_id", "status"]).collect()
    assert {r.column_name: r.failures for r in nn} == {"customer_id": 1, "status": 1}
    assert quality.unique("t", df, "customer_id").first().failures == 1
    av = quality.accepted_values("t", df, "status", ["active", "churned"]).first()
    assert av.failures == 2  # distinct bad values: paused, gone (NULL passes)
    grain = quality.grain_check("t", df, ["customer_id"]).first()
    assert (grain.total_rows, grain.distinct_keys, grain.duplicated_keys) == (4, 3, 1)
    audit = quality.dedup_audit("t", df, df.dropDuplicates(["customer_id"])).first()
    assert (audit.rows_in, audit.rows_out, audit.rows_removed) == (4, 3, 1)


def test_fused_checks_equal_the_single_ones(spark):
    def sub(rows):
        return spark.createDataFrame(rows, "subscription_id STRING, customer_id BIGINT, status STRING")
    bad = sub([("a", 1, "active"), ("a", None, "paused"), (None, 2, "gone"), (None, 3, None), ("b", 4, "paused")])
    fused = {(r.check_name, r.column_name): r.failures for r in quality.check_table("stg_subscriptions", bad).collect()}
    assert fused == {("not_null", "subscription_id"): 2, ("not_null", "customer_id"): 1,
                     ("unique", "subscription_id"): 1, ("accepted_values", "status"): 2}
    empty = quality.check_table("stg_subscriptions", bad.limit(0)).collect()
    assert len(empty) == 4 and all(r.failures == 0 for r in empty)


def test_unaccepted_values_are_counted_without_a_set_of_them(spark):
    """As many unaccepted values as rows: groups are counted, no row holds them all."""
    subs = spark.range(5000).selectExpr("cast(id as string) as subscription_id", "id as customer_id",
                                        "concat('x', id % 4000) as status")
    moves = subs.selectExpr("customer_id", "date'2023-01-01' as month", "status as movement_type")
    for table, df in (("stg_subscriptions", subs), ("fct_arr_movements", moves)):
        checks = quality.check_table(table, df)
        assert "collect_set" not in checks._jdf.queryExecution().optimizedPlan().toString()
        assert [r.failures for r in checks.collect() if r.check_name == "accepted_values"] == [4000]


def test_status_of_a_row_without_a_month_counts_as_latest(spark):
    from quarterlens.operators.customers import customer_activity
    subs = spark.createDataFrame([(1, d("2023-05-01"), "active"), (1, None, "churned"), (2, d("2023-05-01"), "active")],
                                 "customer_id BIGINT, month DATE, status STRING")
    assert {r.customer_id: r.current_status for r in customer_activity(subs).collect()} == {1: "churned", 2: "active"}


def test_queries_without_a_calendar_plan_without_a_job(spark):
    from quarterlens.plans.registry import queries
    tracker, group = spark.sparkContext.statusTracker(), "no-job-while-planning"
    spark.sparkContext.setJobGroup(group, group)
    try:
        for key in ("stg_customers", "stg_subscriptions", "stg_invoices", "stg_usage_events", "late_invoices",
                    "dq_dedup_audit"):
            queries()[key](spark, "/root/testdata/sf0.001")
        assert list(tracker.getJobIdsForGroup(group)) == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_unique_deals_groups_by_the_rows_there_are(spark, monkeypatch):
    monkeypatch.setattr(quality, "GROUPS_A_TASK", 100)
    ids = [f"S{i % 950}" for i in range(1000)] + [None] * 40 + ["HOT"] * 200
    df = spark.createDataFrame([(i,) for i in ids], "subscription_id string").repartition(4)
    for rows in (None, len(ids), 0):
        assert quality.unique("stg_subscriptions", df, "subscription_id", rows).first().failures == 51
    # a task's groups are bounded by the number of rows, whatever they take as bytes, also after a group-by on the key
    for frame, rows, tasks in ((df, 1240, "13"), (df.distinct(), 951, "10"), (df.distinct(), None, "8")):
        plan = quality.unique("stg_subscriptions", frame, "subscription_id", rows)._jdf.queryExecution().toString()
        assert f", {tasks}), REPARTITION_BY_NUM" in plan


def test_latest_status_holds_a_row_per_group(spark):
    from quarterlens.operators.customers import customer_activity

    rows = [(1, "2023-02-01", "active"), (1, None, "active"), (1, "2023-09-01", "churned"), (2, "2023-03-01", None),
            (2, "2023-03-01", "active"), (3, "2023-05-01", "churned"), (3, "2023-05-01", "active"), (None, None, None)]
    subs = spark.createDataFrame([(c, m and d(m), s) for c, m, s in rows], "customer_id int, month date, status string")
    got = customer_activity(subs)
    assert {r.customer_id: (r.first_active_month, r.current_status) for r in got.collect()} == {
        1: (d("2023-02-01"), "active"), 2: (d("2023-03-01"), "active"), 3: (d("2023-05-01"), "churned"), None: (None, None)}
    # the rows of a task go into a hash aggregate; only the groups of customer and status are sorted
    plan = got._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
    assert plan.rindex("HashAggregate") > plan.rindex("SortAggregate")
