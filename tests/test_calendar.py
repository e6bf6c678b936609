import datetime as dt

from pyspark.sql import functions as F

from conftest import SF_MID, d
from quarterlens.operators import calendar
from quarterlens.sources.driver import DriverTables


def _labels(cal):
    return {r.month_date: (r.fiscal_year, r.fiscal_quarter, r.fiscal_quarter_number)
            for r in cal.collect()}


def test_default_calendar_boundaries(spark):
    cal = calendar.fiscal_calendar(spark)  # 36 months from 2023-02-01
    rows = _labels(cal)
    assert len(rows) == 36
    assert min(rows) == d("2023-02-01") and max(rows) == d("2026-01-01")
    # hand-checked boundary cases of the original model
    assert rows[d("2025-02-01")] == (2026, "FY2026-Q1", 1)
    assert rows[d("2025-08-01")] == (2026, "FY2026-Q3", 3)
    assert rows[d("2026-01-01")] == (2026, "FY2026-Q4", 4)
    assert rows[d("2023-04-01")] == (2024, "FY2024-Q1", 1)
    assert rows[d("2023-05-01")] == (2024, "FY2024-Q2", 2)


def test_calendar_schema(spark):
    cal = calendar.fiscal_calendar(spark, "2023-02-01", 3)
    assert cal.columns == ["month_date", "fiscal_year", "fiscal_quarter",
                           "fiscal_quarter_number", "calendar_year", "calendar_month"]
    types = dict(cal.dtypes)
    assert types["month_date"] == "date" and types["fiscal_year"] == "int"


def test_calendar_span_matches_lazy_rule(spark):
    orders = DriverTables(spark, SF_MID)("orders", "o_orderdate")
    start, months = calendar.calendar_span(orders, "o_orderdate")
    assert (start, months) == ("1994-11-01", 84)
    eager = calendar.fiscal_calendar(spark, start, months)
    lazy = calendar.fiscal_calendar_for(orders, "o_orderdate")
    assert sorted(eager.collect()) == sorted(lazy.collect())


def test_span_rule_on_quarter_aligned_data(spark):
    df = spark.createDataFrame([(d("2023-02-01"),), (d("2026-01-31"),)], "t DATE")
    assert calendar.calendar_span(df, "t") == ("2023-02-01", 36)
    short = spark.createDataFrame([(d("2023-03-01"),), (d("2023-05-01"),)], "t DATE")
    assert calendar.calendar_span(short, "t") == ("2023-02-01", 6)
    assert calendar.fiscal_calendar_for(short, "t").count() == 6
    assert calendar.fiscal_calendar_for(short.limit(0), "t").count() == 0
    # one stray date makes a long calendar, not an error
    stray = spark.createDataFrame([(d("1700-01-01"),), (d("2023-05-01"),)], "t DATE")
    start, months = calendar.calendar_span(stray, "t")
    assert calendar.fiscal_calendar_for(stray, "t").count() == months == 3885
    assert len(calendar.quarter_labels(start, months)) == months // 3
    assert calendar.calendar_span(None, months_seen=(d("2023-02-01"), d("9999-12-01")))[1] % 3 == 0


def test_quarter_labels_follow_the_calendar(spark):
    cal = calendar.fiscal_calendar(spark, "1994-11-01", 84)
    seen = [r[0] for r in cal.orderBy("month_date").select("fiscal_quarter").collect()]
    assert calendar.quarter_labels("1994-11-01", 84) == list(dict.fromkeys(seen))


def test_quarter_end_months(spark):
    cal = calendar.fiscal_calendar(spark)
    ends = {r.fiscal_quarter: r.quarter_end_month
            for r in calendar.quarter_end_months(cal).collect()}
    assert ends["FY2026-Q3"] == d("2025-10-01")
    assert ends["FY2026-Q4"] == d("2026-01-01")
    assert len(ends) == 12


def test_calendar_month_index_is_integer(spark):
    cal = calendar.fiscal_calendar(spark, "2023-01-01", 12)
    nums = cal.orderBy("month_date").select("fiscal_quarter_number").collect()
    assert [r[0] for r in nums] == [4, 1, 1, 1, 2, 2, 2, 3, 3, 3, 4, 4]
    assert cal.where(F.col("fiscal_quarter").contains(".")).count() == 0
    assert isinstance(cal.first().month_date, dt.date)


def _brute_span(lo, hi, fy_start=2):
    """All months of the fiscal quarters that a month of lo..hi belongs to."""
    def quarter(y, m):
        return (y - (m < fy_start), (m - fy_start) % 12 // 3)

    wanted = set()
    y, m = lo.year, lo.month
    while (y, m) <= (hi.year, hi.month):
        wanted.add(quarter(y, m))
        y, m = (y + 1, 1) if m == 12 else (y, m + 1)
    kept = [dt.date(y, m, 1) for y in range(lo.year - 1, hi.year + 2) for m in range(1, 13)
            if quarter(y, m) in wanted]
    return kept[0].isoformat(), len(kept)


from hypothesis import given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402


@settings(max_examples=300, deadline=None)
@given(st.dates(min_value=dt.date(1990, 1, 1), max_value=dt.date(2030, 12, 31)),
       st.integers(min_value=0, max_value=60))
def test_calendar_span_rule_matches_brute_force(lo, extra_months):
    lo = lo.replace(day=1)
    k = lo.year * 12 + lo.month - 1 + extra_months
    hi = dt.date(k // 12, k % 12 + 1, 1)
    start, months = calendar.calendar_span(None, months_seen=(lo, hi))
    assert (start, months) == _brute_span(lo, hi)
