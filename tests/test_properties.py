"""Movements and the waterfall against brute-force Python on random frames."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from conftest import subs_frame
from quarterlens.operators import arr, calendar, staging, waterfall

RATES = {"Starter": 2400, "Growth": 14400, "Enterprise": 72000}
MONTHS = [dt.date(2023 + (m - 1) // 12, (m - 1) % 12 + 1, 1) for m in range(1, 40)]


def brute_movements(rows):
    out = []
    for c in sorted({r[0] for r in rows}):
        known = sorted((m, t, s) for cc, m, t, s in rows if cc == c and t is not None)
        prior = None
        for m, t, s in known:
            cur = 0 if s == "churned" else RATES.get(t, 0)
            if prior is None or cur != prior:
                if prior is None:
                    kind = "new"
                elif prior == 0 and cur > 0:
                    kind = "reactivation"
                elif prior > 0 and cur > prior:
                    kind = "expansion"
                elif prior > 0 and 0 < cur < prior:
                    kind = "contraction"
                elif prior > 0 and cur == 0:
                    kind = "churn"
                else:
                    kind = None
                if kind:
                    out.append((c, m, prior, cur, cur - (prior or 0), kind))
            prior = cur
    return sorted(out)


row = st.tuples(
    st.sampled_from([1, 1, 1, 1, 2, 3, 4]),  # customer 1 is hot
    st.sampled_from(MONTHS),
    st.sampled_from(["Starter", "Growth", "Enterprise", "Platinum", None]),
    st.sampled_from(["active", "active", "churned"]),
)


def unique_months(rows):
    seen, out = set(), []
    for r in rows:
        if (r[0], r[1]) not in seen:
            seen.add((r[0], r[1]))
            out.append(r)
    return out


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(row, min_size=1, max_size=40).map(unique_months), st.booleans())
def test_movements_match_brute_force(spark, rows, skew_safe):
    cal = calendar.fiscal_calendar(spark)
    frame_rows = [(c, m.isoformat(), t, s) for c, m, t, s in rows]
    monthly = arr.monthly_arr(staging.stage_subscriptions(subs_frame(spark, frame_rows)), cal)
    got = sorted((r.customer_id, r.month, r.prior_arr, r.current_arr, r.arr_delta,
                  r.movement_type)
                 for r in arr.arr_movements(monthly, skew_safe=skew_safe).collect())
    assert got == brute_movements(rows)
    # quarterly sums equal the brute-force sums per quarter label
    labels = {r.month_date: r.fiscal_quarter for r in cal.collect()}
    want = {}
    for c, m, p, cur, delta, kind in brute_movements(rows):
        key = labels.get(m)
        want.setdefault(key, {k: 0 for k in RATES_KINDS})[kind] += delta
    qm = waterfall.quarterly_movements(arr.arr_movements(monthly)).collect()
    got_q = {r.fiscal_quarter: {k: r[f"{k}_arr"] for k in RATES_KINDS} for r in qm}
    assert got_q == want


RATES_KINDS = ["new", "reactivation", "expansion", "contraction", "churn"]


INV_SCHEMA = ("invoice_id STRING, customer_id BIGINT, invoice_date DATE, period_month DATE, "
              "amount DECIMAL(12,2), source_order STRUCT<p: DOUBLE, q: BIGINT>")

inv_row = st.tuples(
    st.sampled_from(["A", "B", "C", "HOT", "HOT", "HOT"]),
    st.one_of(st.none(), st.sampled_from([dt.date(2023, 2, d) for d in (1, 2, 3)])),
    st.integers(min_value=0, max_value=3),   # price -> ties are common
    st.integers(min_value=0, max_value=1000),
)


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(inv_row, min_size=1, max_size=30,
                unique_by=lambda r: (r[0], r[2], r[3])))  # the sort key is total
def test_invoice_dedup_matches_brute_force(spark, rows):
    from decimal import Decimal

    from quarterlens.operators import staging
    data = [(i, 7, d, dt.date(2023, 2, 1), Decimal(p), (float(p), q)) for i, d, p, q in rows]
    got = {r.invoice_id: (r.invoice_date, r.amount) for r in staging.stage_invoices(
        spark.createDataFrame(data, INV_SCHEMA), ["source_order"]).collect()}
    want = {}
    for i, d, p, q in sorted(rows, key=lambda r: (r[1] is None, r[1] or dt.date.min,
                                                  float(r[2]), r[3])):
        want.setdefault(i, (d, Decimal(p).quantize(Decimal("0.01"))))
    assert got == want


CUST_SCHEMA = "customer_id BIGINT, signup_date DATE, region STRING, initial_plan_tier STRING"
NRR_MONTHS = MONTHS[1:20]  # 2023-02 .. 2024-08, inside the default calendar


def fq_of(d):
    fy = d.year + 1 if d.month >= 2 else d.year
    return f"FY{fy}-Q{((d.month - 2) % 12) // 3 + 1}"


def brute_nrr(subs, custs):
    arr = {}
    for c, m, t, s in subs:
        if t is None:
            continue  # missing tier: no ARR
        arr.setdefault(c, []).append((fq_of(m), 0 if s == "churned" else RATES.get(t, 0)))
    cohort = {c: fq_of(d) for c, d in custs}
    members = {c for c, q in cohort.items()
               if any(fq == q and a > 0 for fq, a in arr.get(c, []))}
    fwd = {}
    for c in members:
        for fq, a in arr[c]:
            if fq >= cohort[c]:
                fwd[(cohort[c], fq)] = fwd.get((cohort[c], fq), 0) + a
    return {k: (fwd[(k[0], k[0])], v) for k, v in fwd.items()}


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(1, 6), st.sampled_from(NRR_MONTHS),
                          st.sampled_from(["Starter", "Growth", "Enterprise", None]),
                          st.sampled_from(["active", "active", "churned"])),
                min_size=1, max_size=50).map(unique_months),
       st.lists(st.sampled_from(NRR_MONTHS), min_size=6, max_size=6))
def test_nrr_matches_brute_force(spark, rows, signups):
    from quarterlens.operators import customers, nrr
    cal = calendar.fiscal_calendar(spark)
    custs = [(c, signups[c - 1]) for c in range(1, 7)]
    subs = staging.stage_subscriptions(
        subs_frame(spark, [(c, m.isoformat(), t, s) for c, m, t, s in rows]))
    cust_df = staging.stage_customers(spark.createDataFrame(
        [(c, d, "NA", "Starter") for c, d in custs], CUST_SCHEMA))
    dim = customers.dim_customers(cust_df, subs, cal)
    cq = nrr.cohort_quarters(dim, nrr.customer_quarters(arr.monthly_arr(subs, cal), cal))
    got = {(r.cohort_quarter, r.fiscal_quarter): (r.cohort_starting_arr, r.cohort_current_arr,
                                                 r.nrr_pct)
           for r in nrr.nrr_cohorts(nrr.cohort_forward(cq)).collect()}
    want = brute_nrr(rows, custs)
    assert {k: v[:2] for k, v in got.items()} == want
    for (start, cur, pct) in got.values():
        assert abs(pct - cur / start * 100) <= 0.005 + 1e-9
