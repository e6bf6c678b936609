"""Sinks that keep what they do not write, readers that see faults, and checks inside plans."""

import hashlib
import os
import random
import re

import pytest
from pyspark.sql import functions as F

from conftest import SUB_SCHEMA, d, subs_frame
from quarterlens.operators import calendar, customers, intervals, nrr, quality, reporting, semantic
from quarterlens.operators.arr import monthly_arr
from quarterlens.plans.model import RevenueModel
from quarterlens.sources import bronze, marts

SF = "/root/testdata/sf0.001"


def files(folder):
    """Path -> digest of the files below a folder, without the writer's own marks."""
    out = {}
    for top, _, names in os.walk(folder):
        for n in names:
            if not n.startswith((".", "_")):
                path = os.path.join(top, n)
                with open(path, "rb") as f:
                    out[os.path.relpath(path, folder)] = hashlib.sha256(f.read()).hexdigest()
    return out


# --- S8: one quarter at a time ---------------------------------------------------

@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_closing_a_quarter_leaves_the_others(spark, tmp_path, fmt):
    def tabs(rows):
        return {"summary": spark.createDataFrame(rows, "fiscal_quarter string, arr long")}

    path = str(tmp_path)
    marts.write_close_report(tabs([("FY2026-Q1", 1)]), path, fmt, ["FY2026-Q1"])
    first = files(path)
    assert len(first) == 1
    marts.write_close_report(tabs([("FY2026-Q2", 2), ("FY2026-Q1", 99)]), path, fmt, ["FY2026-Q2"])
    both = files(path)
    assert first.items() < both.items() and len(both) == 2  # Q1 byte for byte, and not from the second call
    marts.write_close_report(tabs([("FY2026-Q2", 3)]), path, fmt, ["FY2026-Q2"])
    back = spark.read.option("header", "true").format(fmt).load(f"{path}/summary")
    assert sorted((r.fiscal_quarter, int(r.arr)) for r in back.collect()) == [("FY2026-Q1", 1), ("FY2026-Q2", 3)]
    # A quarter that has lost its rows loses its folder; the other way round, the whole report is replaced.
    marts.write_close_report(tabs([("FY2026-Q1", 5)]), path, fmt, ["FY2026-Q2"])
    assert files(path) == first
    marts.write_close_report(tabs([("FY2026-Q3", 4)]), path, fmt)
    assert [re.search(r"=([^/]*)/", p)[1] for p in files(path)] == ["FY2026-Q3"]


def test_the_model_closes_one_quarter(spark, tmp_path):
    m = RevenueModel.from_driver(spark, SF)
    path = str(tmp_path)
    m.write_close_report(path, "FY1996-Q1")
    before = files(path)
    m.write_close_report(path, "FY1996-Q2")
    after = files(path)
    assert before.items() < after.items()
    assert {re.search(r"=([^/]*)/", p)[1] for p in after} == {"FY1996-Q1", "FY1996-Q2"}
    with pytest.raises(KeyError):
        m.write_close_report(path, "FY1800-Q1")


def test_a_quarter_without_a_headline_fails(spark):
    waterfall = spark.createDataFrame([("FY2026-Q1", 10, 0, 10, 1.0, 0, 0)], "fiscal_quarter string, ending_arr long, "
                                      "beginning_arr long, net_new_arr long, qoq_growth_pct double, churn_arr long, expansion_arr long")
    moves = spark.createDataFrame([], "fiscal_quarter string, movement_type string, arr_delta long")
    ratios = spark.createDataFrame([], "fiscal_quarter string, cohort_quarter string, cohort_starting_arr long, "
                                   "cohort_current_arr long, nrr_pct double")
    tabs = reporting.close_report(waterfall, moves, ratios, "FY2026-Q1")
    assert tabs["summary"].first().ending_arr == 10 and tabs["movements"].count() == 0
    missing = reporting.close_report(waterfall, moves, ratios, "FY2026-Q2")["summary"]  # lazy: nothing has run yet
    for run in (missing.collect, missing.count, lambda: missing.select("ending_arr").collect()):
        with pytest.raises(Exception, match="no headline row for fiscal quarter FY2026-Q2"):
            run()


# --- S1: rows that do not read as declared ----------------------------------------

FILES = {
    "raw_customers": "region,customer_id,signup_date,initial_plan_tier\nEU,1,2024-01-05,Growth\n"
                     "US,2,01/02/2025,Starter\nUS,3,,Starter\n",
    "raw_subscriptions": "customer_id,subscription_id,month,plan_tier,mrr,status,extra\n1,S1,2025-02-01,Growth,12.50,active,x\n"
                         "1,S2,01/02/2025,Growth,abc,active,x\n2,S3,2025-03-01\n2,S4,2025-03-01,Growth,1,active,x,y\n"
                         "3,S5,2025-04-01,,,churned,x\n",
    "raw_invoices": "invoice_id,customer_id,invoice_date,period_month,amount\nI,1,2025-01-01,2025-01-01,99999999999999\n",
    "raw_usage_events": "Event_ID , customer_id,event_date,event_type\nE,1,2025-01-01,login\n",
}


def write_files(root, files=FILES, name="a.csv"):
    for table, text in files.items():
        os.makedirs(f"{root}/{table}", exist_ok=True)
        with open(f"{root}/{table}/{name}", "w") as f:
            f.write(text)
    return str(root)


def test_csv_is_read_by_name_and_faults_are_kept_apart(spark, tmp_path):
    root = write_files(tmp_path / "in")
    tables, rejected = bronze.split_bronze(spark, root, "csv")
    subs = tables["raw_subscriptions"]
    assert [(r.subscription_id, r.customer_id, r.month, r.plan_tier) for r in subs.orderBy("subscription_id").collect()] == [
        ("S1", "1", d("2025-02-01"), "Growth"), ("S5", "3", d("2025-04-01"), None)]
    found = {(r.table_name, p.column_name, p.value) for r in rejected.collect() for p in r.problems}
    assert found == {
        ("raw_customers", "signup_date", "01/02/2025"), ("raw_subscriptions", "month", "01/02/2025"),
        ("raw_subscriptions", "mrr", "abc"), ("raw_subscriptions", "_corrupt_record", "2,S3,2025-03-01"),
        ("raw_subscriptions", "_corrupt_record", "2,S4,2025-03-01,Growth,1,active,x,y"),
        ("raw_invoices", "amount", "99999999999999")}
    # Rows read and rejected add up to the input, whatever columns are asked for.
    bad = {r.table_name: r["count"] for r in rejected.groupBy("table_name").count().collect()}
    for name, text in FILES.items():
        assert tables[name].count() + bad.get(name, 0) == text.count("\n") - 1
        assert len(tables[name].select(tables[name].columns[-1]).collect()) == tables[name].count()


def test_reader_fails_or_writes_the_quarantine(spark, tmp_path):
    root, kept = write_files(tmp_path / "in"), str(tmp_path / "quarantine")
    plain = bronze.read_bronze_tables(spark, root, "csv")
    assert plain["raw_usage_events"].first().event_id == "E"
    for run in (plain["raw_subscriptions"].count, plain["raw_subscriptions"].select("status").collect):
        with pytest.raises(Exception, match="raw_subscriptions: cannot read"):
            run()
    tables = bronze.read_bronze_tables(spark, root, "csv", quarantine=kept)
    assert tables["raw_subscriptions"].count() == 2
    assert spark.read.parquet(kept).count() == 5
    model = RevenueModel.from_bronze(spark, root, "csv", quarantine=kept)
    assert model.dim_customers.count() == 2


def test_headers_have_to_agree(spark, tmp_path):
    root = write_files(tmp_path)
    write_files(tmp_path, {"raw_usage_events": "customer_id,event_id,event_date,event_type\n1,E,2025-01-01,login\n"}, "b.csv")
    with pytest.raises(Exception, match="(?i)header"):
        bronze.read_bronze_tables(spark, root, "csv")["raw_usage_events"].collect()
    for text, said in (("event_id,customer_id,event_type\n", "lacks"), ("event_id,EVENT_ID,customer_id,event_date,event_type\n", "more than once")):
        with pytest.raises(ValueError, match=said):
            bronze.split_rows(spark.createDataFrame([], ", ".join(f"`{c}` string" for c in text.strip().split(",")))
                              if said == "lacks" else _twice(spark), "raw_usage_events")


def _twice(spark):
    spark.conf.set("spark.sql.caseSensitive", "true")
    try:
        return spark.createDataFrame([], "event_id string, EVENT_ID string, customer_id string, event_date string, event_type string")
    finally:
        spark.conf.unset("spark.sql.caseSensitive")


def test_json_and_typed_tables(spark, tmp_path):
    os.makedirs(tmp_path / "raw_usage_events")
    with open(tmp_path / "raw_usage_events" / "a.json", "w") as f:
        f.write('{"event_type": "login", "event_id": "1", "customer_id": "7", "event_date": "2025-01-01"}\n'
                '{"event_id": "2", "event_date": "soon"}\n{broken\n')
    raw = bronze.as_it_stands(spark, str(tmp_path / "raw_usage_events"), "raw_usage_events", "json")
    good, bad = bronze.split_rows(raw, "raw_usage_events")
    assert [tuple(r) for r in good.collect()] == [("1", "7", d("2025-01-01"), "login")]
    assert {(p.column_name, p.value) for r in bad.collect() for p in r.problems} == {
        ("event_date", "soon"), ("_corrupt_record", "{broken")}
    typed = subs_frame(spark, [(1, "2025-02-01", "Growth", "active")])
    good, bad = bronze.split_rows(typed, "raw_subscriptions")
    assert good.schema["customer_id"].dataType.simpleString() == "bigint" and good.count() == 1 and bad.count() == 0


# --- S4: versions -----------------------------------------------------------------

def test_a_build_that_dies_leaves_the_old_version(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    m = RevenueModel.from_driver(spark, SF)
    m.build(root)
    store = marts.MartStore(spark, root)
    before, was = store.record(), files(root)
    old = sorted(store.read("fct_revenue_waterfall").collect())
    write = marts.write_mart
    for dies_at in range(1, 7):  # six writes: silver and five marts
        calls = []

        def failing(df, target, *a, **b):
            calls.append(target)
            if len(calls) >= dies_at:
                raise OSError("disk full")
            write(df, target, *a, **b)

        monkeypatch.setattr(marts, "write_mart", failing)
        with pytest.raises(OSError):
            m.build(root, concurrent_writes=1)
        assert store.record() == before and files(root) == was  # nothing left behind either
    # The process is killed after all writes, before or in the commit.
    monkeypatch.setattr(marts, "write_mart", write)
    monkeypatch.setattr(marts.MartStore, "commit", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt()))
    monkeypatch.setattr(marts.MartStore, "discard", lambda *a: None)
    with pytest.raises(KeyboardInterrupt):
        m.build(root)
    assert store.record() == before and was.items() < files(root).items()
    assert sorted(store.read("fct_revenue_waterfall").collect()) == old


def test_versions_are_whole_and_expire(spark, tmp_path):
    store = marts.MartStore(spark, str(tmp_path))
    assert store.record() is None
    with pytest.raises(FileNotFoundError):
        store.read("a")
    first = store.publish({"a": spark.range(1), "b": spark.range(10)})
    reader = store.read("a")
    second = store.publish({"a": spark.range(2)})
    assert second["version"] == 2 and store.read("a").count() == 2 and store.read("b").count() == 10
    assert store.read("a", record=first).count() == 1
    store.expire()
    assert reader.count() == 1  # one version back still reads
    third = store.publish({"a": spark.range(3)})
    os.makedirs(tmp_path / "versions" / "20200101T000000_dead")
    os.makedirs(tmp_path / "versions" / f"{marts._new_run()}")
    os.makedirs(tmp_path / "versions" / "someones")
    store.expire()
    runs = sorted(os.listdir(tmp_path / "versions"))
    assert "20200101T000000_dead" not in runs and "someones" in runs and len(runs) == 5  # b's, a's two, a live build's
    assert store.record() == third and store.read("b").count() == 10 and store.read("a").count() == 3
    with pytest.raises(FileNotFoundError):
        store.read("b", "silver")


def test_catalog_layers_change_together(spark, monkeypatch):
    for layer in ("silver", "gold"):
        spark.sql(f"DROP DATABASE IF EXISTS ql_layers_{layer} CASCADE")
    m = RevenueModel.from_driver(spark, SF)
    built = m.build("ql_layers", as_tables=True)
    names = {t.name for t in spark.catalog.listTables("ql_layers_gold")}
    assert names >= {"dim_customers", "fct_nrr_cohorts"} and "stg_subscriptions" not in names
    assert {t.name for t in spark.catalog.listTables("ql_layers_silver")} >= {"stg_subscriptions"}
    assert sorted(built.waterfall.collect()) == sorted(m.waterfall.collect())
    write, calls = marts.write_mart, []

    def failing(df, target, *a, **b):
        if "fct_nrr_cohorts" in target:
            raise OSError("disk full")
        calls.append(target)
        write(df.where(F.rand() > 2), target, *a, **b)

    monkeypatch.setattr(marts, "write_mart", failing)
    with pytest.raises(OSError):
        m.build("ql_layers", as_tables=True)
    assert calls and {t.name for t in spark.catalog.listTables("ql_layers_gold")} == names
    assert spark.table("ql_layers_gold.fct_revenue_waterfall").count() == m.waterfall.count() > 0
    monkeypatch.setattr(marts, "write_mart", write)
    m.build("ql_layers", as_tables=True)
    m.build("ql_layers", as_tables=True)
    kept = [t.name for t in spark.catalog.listTables("ql_layers_gold") if t.name.startswith("dim_customers__")]
    assert len(kept) == marts.KEEP_VERSIONS
    spark.sql("DROP VIEW ql_layers_gold.dim_customers")
    spark.range(1).write.saveAsTable("ql_layers_gold.dim_customers")
    with pytest.raises(ValueError, match="not a view"):
        m.build("ql_layers", as_tables=True)


def test_bucketed_silver_needs_no_customer_shuffle(spark):
    for layer in ("silver", "gold"):
        spark.sql(f"DROP DATABASE IF EXISTS ql_buckets_{layer} CASCADE")
    m = RevenueModel.from_driver(spark, SF)
    built = m.build("ql_buckets", as_tables=True, buckets=4)
    assert sorted(built.waterfall.collect()) == sorted(m.waterfall.collect())
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        again = built.with_bronze()
        for name in ("stg_customers", "stg_subscriptions"):
            again.__dict__[name] = spark.table(f"ql_buckets_silver.{name}")
        # Without broadcasts the calendar joins are shuffled by month; label the months by rule instead.
        months = again.stg_subscriptions.where("not is_missing_tier").select(
            "customer_id", "month", "plan_tier", F.lit("FY1996-Q1").alias("fiscal_quarter"), F.lit(1).alias("tier_arr"))
        from quarterlens.operators.arr import with_movements
        lag = with_movements(months, skew_safe=False)
        activity = again.stg_customers.join(customers.customer_activity(again.stg_subscriptions), "customer_id", "left")
        dim = activity.withColumn("signup_fiscal_quarter", F.lit("FY1996-Q1"))
        joined = nrr.cohort_quarters(dim, nrr.customer_quarters(months))
        for df in (lag, activity, joined):
            plan = df._jdf.queryExecution().executedPlan().toString()
            assert "Exchange" not in plan and "Bucketed: true" in plan, plan
        assert joined.count() > 0
        assert sorted(again.dim_customers.collect(), key=str) == sorted(m.dim_customers.collect(), key=str)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    with pytest.raises(ValueError):
        m.build("/nowhere", buckets=4)


# --- checks -----------------------------------------------------------------------

def test_a_cell_with_two_rows_fails_the_matrix(spark):
    schema = "cohort_quarter string, fiscal_quarter string, nrr_pct double"
    fine = spark.createDataFrame([("C1", "Q1", 100.0), ("C1", "Q2", None), ("C2", "Q2", 90.0)], schema)
    assert [tuple(r) for r in nrr.nrr_matrix(fine, ["Q1", "Q2"]).orderBy("cohort_quarter").collect()] == [
        ("C1", 100.0, None), ("C2", None, 90.0)]
    for extra in (90.0, 100.0, None):
        twice = nrr.nrr_matrix(fine.unionByName(spark.createDataFrame([("C1", "Q1", extra)], schema)), ["Q1", "Q2"])
        with pytest.raises(Exception, match="2 rows for cohort C1 in quarter Q1"):
            twice.collect()


@pytest.mark.parametrize("faulty", [False, True])
def test_observed_checks_equal_the_scanned_ones(spark, tmp_path, faulty):
    rows = [("a", 1, "2025-01-01", "Growth", "active"), ("b", 2, "2025-01-01", "Growth", "churned")]
    if faulty:
        rows += [("a", None, "2025-01-01", "Growth", "paused"), (None, 2, None, None, "gone"), (None, 3, None, None, None),
                 ("c", 4, None, None, "paused")]
    subs = spark.createDataFrame(rows, "subscription_id string, customer_id int, month string, plan_tier string, status string")
    moves = spark.createDataFrame([(1, "2025-01-01", "new"), (None, None, None if not faulty else "lost")],
                                  "customer_id int, month string, movement_type string")
    for table, df in (("stg_subscriptions", subs), ("fct_arr_movements", moves)):
        marked, seen = quality.observe_table(table, df.repartition(3))
        marked.write.parquet(str(tmp_path / table))
        back = spark.read.parquet(str(tmp_path / table))
        want = quality.check_table(table, df)
        assert sorted(quality.observed_checks(table, back, seen.get).select(*quality.RESULT_COLUMNS).collect()) == \
            sorted(want.select(*quality.RESULT_COLUMNS).collect())


def test_built_model_reports_what_was_observed(spark, tmp_path):
    m = RevenueModel.from_driver(spark, SF)
    built = m.build(str(tmp_path))
    assert set(built.observed) == set(marts_with_checks())
    assert sorted(built.data_quality().collect()) == sorted(m.data_quality().collect())


def marts_with_checks():
    return ["stg_subscriptions", "dim_fiscal_calendar", "dim_customers", "fct_arr_movements", "fct_revenue_waterfall",
            "fct_nrr_cohorts"]


def test_dimensions_are_checked(spark):
    schema = "fiscal_quarter string, churn_arr long, ending_arr long"
    frames = {"revenue_waterfall": spark.createDataFrame([("FY1", 5, 50), ("FY2", 6, 60)], schema)}
    assert semantic.metric(frames, "churn", where={"period": "FY2"}).first()[0] == 6
    for by in ((), ("quarter",)):
        with pytest.raises(Exception, match="'FY9' is no fiscal_quarter of revenue_waterfall"):
            semantic.metric(frames, "churn", by=by, where={"period": "FY9"}).collect()
    twice = {"revenue_waterfall": spark.createDataFrame([("FY1", 5, 50), ("FY1", 6, 60), (None, 1, 1), (None, 1, 1)], schema)}
    with pytest.raises(Exception, match="more than one row for fiscal_quarter FY1"):
        semantic.metric(twice, "churn").collect()
    cohorts = {"nrr_cohorts": spark.createDataFrame([("C1", "Q1", 100.0), ("C1", "Q2", 90.0), ("C2", "Q2", 80.0)],
                                                    "cohort_quarter string, fiscal_quarter string, nrr_pct double")}
    one = semantic.metric(cohorts, "NRR", by=["cohort"], where={"cohort": "C2", "period": "Q1"})
    assert one.collect() == []  # both are members; no row has both
    with pytest.raises(Exception, match="'C3' is no cohort_quarter"):
        semantic.metric(cohorts, "NRR", where={"cohort": "C3", "period": "Q1"}).collect()


# --- intervals ----------------------------------------------------------------------

def month(i):
    return d(f"{2023 + i // 12:04d}-{i % 12 + 1:02d}-01")


@pytest.mark.parametrize("seed", range(4))
def test_intervals_equal_the_monthly_operators(spark, seed):
    """Random spans with churn, unknown tiers, gaps, months outside the calendar and missing single months."""
    rnd = random.Random(seed)
    spans, missing, rows, people = [], [], [], []
    for customer in range(25):
        at = rnd.randint(0, 12)
        people.append((customer, rnd.choice([None, month(at), month(rnd.randint(0, 30))])))
        while at < 30:
            last, tier, status = at + rnd.randint(0, 8), rnd.choice(["Starter", "Growth", "Enterprise", "Gold", None]), \
                rnd.choice(["active", "active", "churned"])
            spans.append((customer, month(at), month(last), tier, status))
            for i in range(at, last + 1):
                if tier is not None and rnd.random() < 0.15:
                    missing.append((customer, month(i), tier, status))
                else:
                    rows.append((customer, str(month(i)), tier, status))
            at = last + 1 + rnd.choice([0, 0, 3])
    cal = calendar.fiscal_calendar(spark, "2023-05-01", 24)
    monthly = monthly_arr(subs_frame(spark, rows).withColumn("is_missing_tier", F.col("plan_tier").isNull()), cal)
    from quarterlens.operators.waterfall import quarter_ending
    cut = intervals.arr_intervals(
        spark.createDataFrame(spans, "customer_id long, first_month date, last_month date, tier string, status string"),
        spark.createDataFrame(missing, "customer_id long, month date, tier string, status string"))
    assert sorted(intervals.quarter_ending(cut, cal).collect()) == sorted(quarter_ending(monthly, cal).collect())
    dim = spark.createDataFrame(people, "customer_id long, signup date").join(
        cal.select(F.col("month_date").alias("signup"), F.col("fiscal_quarter").alias("signup_fiscal_quarter")), "signup", "left")
    cohort_q = nrr.cohort_quarters(dim, nrr.customer_quarters(monthly, cal))
    members = intervals.member_intervals(nrr.cohort_assignment(dim), cut, cal)
    for measure in ("arr_sum", "arr_qend"):
        assert sorted(intervals.cohort_forward(members, cal, measure).collect()) == \
            sorted(nrr.cohort_forward(cohort_q, measure).collect())


def test_intervals_of_no_rows(spark):
    cal = calendar.fiscal_calendar(spark, "2023-05-01", 6)
    none = intervals.arr_intervals(spark.createDataFrame(
        [], "customer_id long, first_month date, last_month date, tier string, status string"))
    assert intervals.quarter_ending(none, cal).count() == 0
    cohorts = spark.createDataFrame([(1, "FY2024-Q2")], "customer_id long, cohort_quarter string")
    assert intervals.cohort_forward(intervals.member_intervals(cohorts, none, cal), cal).count() == 0
    with pytest.raises(ValueError):
        intervals.cohort_forward(none, cal, "arr_max")


def test_interval_plans_expand_no_customer_months(spark):
    from quarterlens.plans.registry import queries
    for key in ("interval_quarter_ending", "interval_cohort_forward"):
        plan = queries()[key](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
        assert "first_month" not in plan.split("sequence(")[-1][:200]
        assert "Some(1 months)" not in plan and "INTERVAL '1' MONTH" not in plan


def test_csv_bronze_is_written_compressed_and_reads_back(spark, tmp_path, monkeypatch):
    from quarterlens.plans import registry

    monkeypatch.setattr(registry, "scratch_folder", lambda spark, tag: str(tmp_path / tag))
    rows = registry.bronze_csv_waterfall(spark, SF).collect()
    assert sorted(rows) == sorted(registry.queries()["waterfall"](spark, SF).collect())
    written = {n: [f for f in os.listdir(tmp_path / "bronze-csv" / n) if f.startswith("part-")] for n in bronze.BRONZE_SCHEMAS}
    assert all(written.values()) and all(f.endswith(".csv.gz") for fs in written.values() for f in fs)
