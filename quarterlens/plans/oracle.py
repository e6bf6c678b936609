"""Equivalent SQL for every registered query, for an independent engine.

One WITH-prefix rebuilds the bronze tables from the driver tables (the rules
of FIXTURES.md), the silver views and the gold marts from their definitions in
one customer-quarter aggregate for retention.  Each key adds a final SELECT.
Column names and types match the Spark side: BIGINT sums and counts, INTEGER
ARR per row, DATE months, DOUBLE percentages, DECIMAL(12,2) money.
"""

from __future__ import annotations

from quarterlens.constants import (
    MOVEMENT_TYPES,
    TIER_ARR,
    BRIDGE_COMPONENTS,
    CHURN_SPIKE_THRESHOLD_PCT,
    FIXTURE_VERIFIED_QUARTER,
)
from quarterlens.operators.calendar import quarter_labels

_RATES = ", ".join(f"('{tier}', {arr})" for tier, arr in TIER_ARR.items())
#: The months of the driver tables' orders, to whole fiscal quarters.
_QUARTERS = quarter_labels("1994-11-01", 84)

PREFIX = f"""
WITH
order_months AS (
    SELECT o_custkey AS customer_id,
           CAST(date_trunc('month', o_orderdate) AS DATE) AS change_month,
           o_orderkey, o_totalprice,
           row_number() OVER (
               PARTITION BY o_custkey, CAST(date_trunc('month', o_orderdate) AS DATE)
               ORDER BY o_orderdate DESC NULLS LAST, o_orderkey DESC NULLS LAST) AS rn
    FROM orders
),
changes AS (
    SELECT customer_id, change_month,
           CASE WHEN o_totalprice < 300000 THEN 'Starter'
                WHEN o_totalprice < 450000 THEN 'Growth'
                ELSE 'Enterprise' END AS tier,
           CASE WHEN o_orderkey % 10 = 0 THEN 'churned' ELSE 'active' END AS status
    FROM order_months WHERE rn = 1
),
spans AS (
    SELECT customer_id, change_month, tier, status,
           CASE WHEN status = 'churned' THEN change_month
                ELSE coalesce(CAST(lead(change_month) OVER w - INTERVAL 1 MONTH AS DATE),
                              (SELECT max(change_month) FROM changes)) END AS end_month
    FROM changes
    WINDOW w AS (PARTITION BY customer_id ORDER BY change_month)
),
snap_ts AS (
    SELECT customer_id, tier, status,
           unnest(generate_series(CAST(change_month AS TIMESTAMP),
                                  CAST(end_month AS TIMESTAMP), INTERVAL 1 MONTH)) AS m
    FROM spans
),
snap AS (
    SELECT customer_id, tier, status, CAST(m AS DATE) AS snap_month,
           CAST(year(m) AS BIGINT) * 12 + month(m) AS ym
    FROM snap_ts
),
snap_tier AS (
    SELECT *, CASE WHEN (customer_id * 31 + ym) % 97 = 0 THEN NULL ELSE tier END AS plan_tier
    FROM snap
),
raw_subscriptions AS (
    SELECT concat('SUB-', CAST(customer_id AS VARCHAR), '-', CAST(ym AS VARCHAR)) AS subscription_id,
           customer_id,
           snap_month AS month,
           plan_tier,
           CAST((CASE plan_tier WHEN 'Starter' THEN 2 WHEN 'Growth' THEN 12
                                WHEN 'Enterprise' THEN 60 ELSE 2 END)
                * (90 + (customer_id * 7 + ym) % 21) AS DECIMAL(12,2)) AS mrr,
           status
    FROM snap_tier
),
first_orders AS (
    SELECT o_custkey, o_orderdate, o_totalprice,
           row_number() OVER (PARTITION BY o_custkey
                              ORDER BY o_orderdate ASC NULLS LAST, o_orderkey ASC NULLS LAST) AS rn
    FROM orders
),
raw_customers AS (
    SELECT c.c_custkey AS customer_id,
           CAST(f.o_orderdate AS DATE) AS signup_date,
           g.r_name AS region,
           CASE WHEN f.o_custkey IS NULL THEN NULL
                WHEN f.o_totalprice < 300000 THEN 'Starter'
                WHEN f.o_totalprice < 450000 THEN 'Growth'
                ELSE 'Enterprise' END AS initial_plan_tier
    FROM customer c
    LEFT JOIN (SELECT n.n_nationkey, r.r_name
               FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey) g
           ON c.c_nationkey = g.n_nationkey
    LEFT JOIN first_orders f ON f.o_custkey = c.c_custkey AND f.rn = 1
),
raw_invoices AS (
    SELECT concat('INV-', CAST(l.l_orderkey AS VARCHAR), '-',
                  CAST(l.l_linenumber AS VARCHAR)) AS invoice_id,
           o.o_custkey AS customer_id,
           CAST(l.l_shipdate AS DATE) AS invoice_date,
           CAST(date_trunc('month', o.o_orderdate) AS DATE) AS period_month,
           CAST(l.l_extendedprice AS DECIMAL(12,2)) AS amount,
           l.l_extendedprice AS tb_price, l.l_partkey AS tb_part, l.l_suppkey AS tb_supp
    FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
),
raw_usage_events AS (
    SELECT event_id, user_id AS customer_id, CAST(ts AS DATE) AS event_date, event_type
    FROM events
),
stg_customers AS (
    SELECT customer_id, CAST(signup_date AS DATE) AS signup_date, trim(region) AS region,
           initial_plan_tier
    FROM raw_customers
),
stg_subscriptions AS (
    SELECT subscription_id, customer_id, CAST(month AS DATE) AS month, plan_tier,
           CAST(mrr AS DECIMAL(12,2)) AS mrr, status,
           CASE WHEN plan_tier IS NULL THEN true ELSE false END AS is_missing_tier
    FROM raw_subscriptions
),
stg_invoices AS (
    SELECT invoice_id, customer_id, invoice_date, period_month, amount
    FROM (SELECT *, row_number() OVER (
                      PARTITION BY invoice_id
                      ORDER BY invoice_date ASC NULLS LAST, tb_price, tb_part, tb_supp) AS rn
          FROM raw_invoices) d
    WHERE rn = 1
),
stg_usage_events AS (
    SELECT event_id, customer_id, CAST(event_date AS DATE) AS event_date, event_type
    FROM raw_usage_events
),
-- Months are numbered from the February of year 0, so that a fiscal year is
-- twelve numbers and a fiscal quarter three.
observed AS (
    SELECT min(year(o_orderdate) * 12 + month(o_orderdate) - 2) AS lo,
           max(year(o_orderdate) * 12 + month(o_orderdate) - 2) AS hi
    FROM orders
),
numbered AS (
    SELECT unnest(range(lo - lo % 3, hi - hi % 3 + 3)) AS n FROM observed
),
calendar AS (
    SELECT make_date((n + 1) // 12, (n + 1) % 12 + 1, 1) AS month_date,
           CAST(n // 12 + 1 AS INTEGER) AS fiscal_year,
           format('FY{{}}-Q{{}}', n // 12 + 1, n % 12 // 3 + 1) AS fiscal_quarter,
           CAST(n % 12 // 3 + 1 AS INTEGER) AS fiscal_quarter_number,
           CAST((n + 1) // 12 AS INTEGER) AS calendar_year,
           CAST((n + 1) % 12 + 1 AS INTEGER) AS calendar_month
    FROM numbered
),
quarter_ends AS (
    SELECT fiscal_quarter, max(month_date) AS quarter_end_month FROM calendar GROUP BY ALL
),
rates(plan_tier, yearly) AS (VALUES {_RATES}),
monthly_arr AS (
    SELECT customer_id, month, fiscal_quarter, plan_tier,
           CAST(if(status = 'churned', 0, coalesce(yearly, 0)) AS INTEGER) AS tier_arr
    FROM stg_subscriptions
    LEFT JOIN rates USING (plan_tier)
    LEFT JOIN calendar ON month_date = month
    WHERE NOT is_missing_tier
),
activity AS (
    SELECT customer_id, min(month) AS first_active_month,
           first(status ORDER BY month DESC NULLS FIRST, status DESC) AS current_status
    FROM stg_subscriptions GROUP BY customer_id
),
dim_customers AS (
    SELECT customer_id, signup_date, region, initial_plan_tier, first_active_month,
           fiscal_quarter AS signup_fiscal_quarter, current_status
    FROM stg_customers
    LEFT JOIN activity USING (customer_id)
    LEFT JOIN calendar ON calendar_year = year(signup_date) AND calendar_month = month(signup_date)
),
steps AS (
    SELECT *, lag(tier_arr) OVER (PARTITION BY customer_id
                                  ORDER BY month ASC NULLS LAST, plan_tier, tier_arr) AS prior_arr
    FROM monthly_arr
),
fct_arr_movements AS (
    SELECT customer_id, month, fiscal_quarter, plan_tier, prior_arr, tier_arr AS current_arr,
           CAST(tier_arr - coalesce(prior_arr, 0) AS INTEGER) AS arr_delta,
           CASE WHEN prior_arr IS NULL THEN 'new'
                WHEN prior_arr = 0 THEN 'reactivation'
                WHEN tier_arr = 0 THEN 'churn'
                WHEN tier_arr > prior_arr THEN 'expansion'
                ELSE 'contraction' END AS movement_type
    FROM steps WHERE tier_arr IS DISTINCT FROM prior_arr
),
quarterly_movements AS (
    SELECT fiscal_quarter, {", ".join(
        f"CAST(coalesce(sum(arr_delta) FILTER (movement_type = '{t}'), 0) AS BIGINT) AS {t}_arr"
        for t in MOVEMENT_TYPES)}
    FROM fct_arr_movements GROUP BY fiscal_quarter
),
customer_quarter AS (
    SELECT customer_id, m.fiscal_quarter, sum(tier_arr) AS whole, max(tier_arr) AS peak,
           sum(tier_arr) FILTER (month = quarter_end_month) AS at_end
    FROM monthly_arr m JOIN quarter_ends q ON m.fiscal_quarter = q.fiscal_quarter
    GROUP BY ALL
),
quarter_ending AS (
    SELECT fiscal_quarter, CAST(sum(at_end) AS BIGINT) AS ending_arr
    FROM customer_quarter GROUP BY fiscal_quarter HAVING count(at_end) > 0
),
in_order AS (
    SELECT *, lag(ending_arr) OVER (ORDER BY fiscal_quarter) AS beginning_arr
    FROM quarter_ending JOIN quarterly_movements USING (fiscal_quarter)
),
waterfall AS (
    SELECT fiscal_quarter, beginning_arr, new_arr, reactivation_arr, expansion_arr,
           contraction_arr, churn_arr, ending_arr, ending_arr - beginning_arr AS net_new_arr,
           round(CAST(ending_arr - beginning_arr AS DOUBLE)
                 / nullif(CAST(beginning_arr AS DOUBLE), 0) * 100, 2) AS qoq_growth_pct
    FROM in_order
),
cohort_members AS (
    SELECT customer_id, signup_fiscal_quarter AS cohort_quarter
    FROM dim_customers
    WHERE (customer_id, signup_fiscal_quarter) IN
          (SELECT (customer_id, fiscal_quarter) FROM customer_quarter WHERE peak > 0)
),
retained AS (
    SELECT cohort_quarter, fiscal_quarter, CAST(sum(whole) AS BIGINT) AS whole,
           CAST(sum(at_end) AS BIGINT) AS at_end
    FROM cohort_members JOIN customer_quarter USING (customer_id)
    WHERE fiscal_quarter >= cohort_quarter GROUP BY ALL
),
cohort_forward AS (
    SELECT cohort_quarter, fiscal_quarter, whole AS cohort_current_arr FROM retained
),
cohort_starting AS (
    SELECT cohort_quarter, whole AS cohort_starting_arr FROM retained
    WHERE fiscal_quarter = cohort_quarter
),
nrr_cohorts AS (
    SELECT *, round(CAST(cohort_current_arr AS DOUBLE)
                    / nullif(CAST(cohort_starting_arr AS DOUBLE), 0) * 100, 2) AS nrr_pct
    FROM cohort_forward JOIN cohort_starting USING (cohort_quarter)
),
nrr_cohorts_qend AS (
    SELECT cohort_quarter, fiscal_quarter, start.at_end AS cohort_starting_arr,
           now.at_end AS cohort_current_arr,
           round(CAST(now.at_end AS DOUBLE) / nullif(CAST(start.at_end AS DOUBLE), 0) * 100, 2) AS nrr_pct_qend
    FROM retained now
    JOIN (SELECT cohort_quarter, at_end FROM retained WHERE fiscal_quarter = cohort_quarter) start
         USING (cohort_quarter)
    WHERE now.at_end IS NOT NULL AND start.at_end IS NOT NULL
),
churn_spike AS (
    SELECT fiscal_quarter, abs(churn_arr) AS churn_abs,
           lag(abs(churn_arr)) OVER (ORDER BY fiscal_quarter) AS prior_churn_abs,
           round(CAST(abs(churn_arr) - lag(abs(churn_arr)) OVER (ORDER BY fiscal_quarter) AS DOUBLE)
                 / nullif(CAST(lag(abs(churn_arr)) OVER (ORDER BY fiscal_quarter) AS DOUBLE), 0)
                 * 100, 2) AS churn_change_pct
    FROM waterfall
)
"""

_BAND = ("CASE WHEN nrr_pct >= 100 THEN 'Strong' WHEN nrr_pct >= 80 THEN 'At Risk' "
         "WHEN nrr_pct IS NOT NULL THEN 'Churning' END")

_NOT_NULL = [
    ("stg_customers", "stg_customers", "customer_id"),
    ("stg_subscriptions", "stg_subscriptions", "subscription_id"),
    ("stg_subscriptions", "stg_subscriptions", "customer_id"),
    ("stg_invoices", "stg_invoices", "invoice_id"),
    ("stg_invoices", "stg_invoices", "customer_id"),
    ("stg_usage_events", "stg_usage_events", "event_id"),
    ("dim_fiscal_calendar", "calendar", "month_date"),
    ("dim_customers", "dim_customers", "customer_id"),
    ("fct_arr_movements", "fct_arr_movements", "customer_id"),
    ("fct_arr_movements", "fct_arr_movements", "month"),
    ("fct_arr_movements", "fct_arr_movements", "movement_type"),
    ("fct_revenue_waterfall", "waterfall", "fiscal_quarter"),
    ("fct_nrr_cohorts", "nrr_cohorts", "cohort_quarter"),
    ("fct_nrr_cohorts", "nrr_cohorts", "fiscal_quarter"),
]
_UNIQUE = [
    ("stg_customers", "stg_customers", "customer_id"),
    ("stg_subscriptions", "stg_subscriptions", "subscription_id"),
    ("stg_invoices", "stg_invoices", "invoice_id"),
    ("stg_usage_events", "stg_usage_events", "event_id"),
    ("dim_fiscal_calendar", "calendar", "month_date"),
    ("dim_customers", "dim_customers", "customer_id"),
    ("fct_revenue_waterfall", "waterfall", "fiscal_quarter"),
]
_ACCEPTED = [
    ("stg_subscriptions", "stg_subscriptions", "status", ["active", "churned"]),
    ("fct_arr_movements", "fct_arr_movements", "movement_type",
     ["new", "reactivation", "expansion", "contraction", "churn"]),
]


def _dq_not_null() -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{t}' AS table_name, '{c}' AS column_name, 'not_null' AS check_name, "
        f"CAST(count(*) FILTER (WHERE \"{c}\" IS NULL) AS BIGINT) AS failures FROM {cte}"
        for t, cte, c in _NOT_NULL)


def _dq_unique() -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{t}' AS table_name, '{c}' AS column_name, 'unique' AS check_name, "
        f"CAST((SELECT count(*) FROM (SELECT \"{c}\" FROM {cte} WHERE \"{c}\" IS NOT NULL "
        f"GROUP BY \"{c}\" HAVING count(*) > 1) d) AS BIGINT) AS failures"
        for t, cte, c in _UNIQUE)


def _dq_accepted() -> str:
    parts = []
    for t, cte, c, values in _ACCEPTED:
        vals = ", ".join(f"'{v}'" for v in values)
        parts.append(
            f"SELECT '{t}' AS table_name, '{c}' AS column_name, 'accepted_values' AS check_name, "
            f"CAST((SELECT count(DISTINCT \"{c}\") FROM {cte} WHERE \"{c}\" IS NOT NULL "
            f"AND \"{c}\" NOT IN ({vals})) AS BIGINT) AS failures")
    return "\nUNION ALL\n".join(parts)


def _arr_bridge() -> str:
    parts = []
    for i, (label, col, measure) in enumerate(BRIDGE_COMPONENTS):
        value = f"coalesce({col}, 0)" if col == "beginning_arr" else col
        parts.append(
            f"SELECT fiscal_quarter, CAST({i + 1} AS INTEGER) AS position, "
            f"'{label}' AS component, CAST({value} AS BIGINT) AS arr, "
            f"'{measure}' AS measure FROM waterfall")
    return "\nUNION ALL\n".join(parts)


TAILS: dict[str, str] = {
    "monthly_snapshots": "SELECT * FROM raw_subscriptions",
    "subscription_months": "SELECT customer_id, snap_month AS month, tier AS plan_tier, status FROM snap",
    "fiscal_calendar": "SELECT * FROM calendar",
    "stg_customers": "SELECT * FROM stg_customers",
    "stg_subscriptions": "SELECT * FROM stg_subscriptions",
    "stg_invoices": "SELECT * FROM stg_invoices",
    "stg_usage_events": "SELECT * FROM stg_usage_events",
    "monthly_arr": "SELECT * FROM monthly_arr",
    "dim_customers": "SELECT * FROM dim_customers",
    "arr_movements": "SELECT * FROM fct_arr_movements",
    "arr_movements_skew_safe": "SELECT * FROM fct_arr_movements",
    "quarterly_movements": "SELECT * FROM quarterly_movements",
    "quarter_ending": "SELECT * FROM quarter_ending",
    "waterfall": "SELECT * FROM waterfall ORDER BY fiscal_quarter",
    "cohort_members": "SELECT * FROM cohort_members",
    "cohort_starting": "SELECT * FROM cohort_starting",
    "cohort_forward": "SELECT * FROM cohort_forward",
    "nrr_cohorts": "SELECT * FROM nrr_cohorts ORDER BY cohort_quarter, fiscal_quarter",
    "nrr_cohorts_qend": "SELECT * FROM nrr_cohorts_qend",
    "movement_detail": """
        SELECT fiscal_quarter, movement_type, count(*) AS customers,
               CAST(sum(arr_delta) AS BIGINT) AS arr_delta
        FROM fct_arr_movements WHERE fiscal_quarter IS NOT NULL
        GROUP BY fiscal_quarter, movement_type
        ORDER BY fiscal_quarter, arr_delta DESC""",
    "close_summary": """
        SELECT fiscal_quarter, ending_arr,
               CAST(coalesce(beginning_arr, 0) AS BIGINT) AS beginning_arr,
               CAST(coalesce(net_new_arr, 0) AS BIGINT) AS net_new_arr,
               coalesce(qoq_growth_pct, 0.0) AS qoq_growth_pct,
               churn_arr, expansion_arr
        FROM waterfall""",
    "waterfall_summary": """
        SELECT fiscal_quarter, beginning_arr, new_arr, expansion_arr, contraction_arr,
               churn_arr, ending_arr, qoq_growth_pct
        FROM waterfall ORDER BY fiscal_quarter""",
    "close_nrr": """
        SELECT fiscal_quarter, cohort_quarter, cohort_starting_arr, cohort_current_arr, nrr_pct
        FROM nrr_cohorts ORDER BY fiscal_quarter, cohort_quarter""",
    "arr_bridge": _arr_bridge(),
    "nrr_matrix": "SELECT cohort_quarter, " + ", ".join(
        f"max(CASE WHEN fiscal_quarter = '{q}' THEN nrr_pct END) AS \"{q}\"" for q in _QUARTERS)
        + " FROM nrr_cohorts GROUP BY cohort_quarter",
    "nrr_bands": f"SELECT cohort_quarter, fiscal_quarter, nrr_pct, {_BAND} AS nrr_band "
                 "FROM nrr_cohorts",
    "nrr_latest": f"""
        SELECT fiscal_quarter, cohort_quarter, nrr_pct, {_BAND} AS signal
        FROM nrr_cohorts
        WHERE fiscal_quarter = (SELECT max(fiscal_quarter) FROM nrr_cohorts)""",
    "nrr_trend": """
        SELECT cohort_quarter, fiscal_quarter, nrr_pct,
               CAST(row_number() OVER (PARTITION BY cohort_quarter ORDER BY fiscal_quarter)
                    AS INTEGER) AS quarter_index
        FROM nrr_cohorts""",
    "cohort_list": "SELECT DISTINCT cohort_quarter FROM nrr_cohorts ORDER BY cohort_quarter",
    "quarter_list": "SELECT DISTINCT fiscal_quarter FROM waterfall ORDER BY fiscal_quarter",
    "qoq_series": """
        SELECT fiscal_quarter, qoq_growth_pct, qoq_growth_pct < 0 AS is_negative
        FROM waterfall WHERE qoq_growth_pct IS NOT NULL""",
    "churn_spike": f"""
        SELECT fiscal_quarter, churn_abs, prior_churn_abs, churn_change_pct,
               coalesce(churn_change_pct >= {CHURN_SPIKE_THRESHOLD_PCT}, false) AS is_spike
        FROM churn_spike""",
    "churn_series": f"""
        SELECT fiscal_quarter, churn_abs,
               coalesce(churn_change_pct >= {CHURN_SPIKE_THRESHOLD_PCT}, false) AS is_anomaly
        FROM churn_spike""",
    "yoy_growth": """
        SELECT w.fiscal_quarter, w.ending_arr, p.ending_arr AS ending_arr_year_ago,
               round(CAST(w.ending_arr - p.ending_arr AS DOUBLE)
                     / nullif(CAST(p.ending_arr AS DOUBLE), 0) * 100, 2) AS yoy_growth_pct
        FROM waterfall w
        LEFT JOIN waterfall p
               ON p.fiscal_quarter = 'FY' || CAST(CAST(substr(w.fiscal_quarter, 3, 4) AS INTEGER) - 1
                                                  AS VARCHAR) || substr(w.fiscal_quarter, 7, 3)""",
    "bridge_check": """
        SELECT fiscal_quarter, beginning_arr, ending_arr,
               CAST(coalesce(beginning_arr, 0) + new_arr + reactivation_arr + expansion_arr
                    + contraction_arr + churn_arr AS BIGINT) AS bridge_arr,
               CAST(ending_arr - (coalesce(beginning_arr, 0) + new_arr + reactivation_arr
                    + expansion_arr + contraction_arr + churn_arr) AS BIGINT) AS residual_arr,
               round(CAST(ending_arr - (coalesce(beginning_arr, 0) + new_arr + reactivation_arr
                          + expansion_arr + contraction_arr + churn_arr) AS DOUBLE)
                     / nullif(CAST(ending_arr AS DOUBLE), 0) * 100, 2) AS residual_pct
        FROM waterfall""",
    "movement_distribution": """
        SELECT movement_type, count(*) AS movements FROM fct_arr_movements
        GROUP BY movement_type""",
    "metric_waterfall": """
        SELECT fiscal_quarter,
               CAST(sum(ending_arr) AS BIGINT) AS ending_arr_metric,
               CAST(sum(net_new_arr) AS BIGINT) AS net_new_arr_metric,
               CAST(sum(churn_arr) AS BIGINT) AS churn_arr_metric,
               CAST(sum(expansion_arr) AS BIGINT) AS expansion_arr_metric
        FROM waterfall GROUP BY fiscal_quarter""",
    "metric_avg_nrr": """
        SELECT fiscal_quarter,
               CAST(avg(CAST(nrr_pct AS DECIMAL(12,2))) AS DECIMAL(18,6)) AS avg_nrr_pct
        FROM nrr_cohorts GROUP BY fiscal_quarter""",
    "metric_fact_synonym": """
        SELECT fiscal_quarter, ending_arr, expansion_arr, qoq_growth_pct FROM waterfall""",
    "metric_where": f"""
        SELECT beginning_arr, churn_arr FROM waterfall
        WHERE fiscal_quarter = '{FIXTURE_VERIFIED_QUARTER}'""",
    "metric_nrr_by_cohort": """
        SELECT cohort_quarter,
               CAST(avg(CAST(nrr_pct AS DECIMAL(12,2))) AS DECIMAL(18,6)) AS avg_nrr_pct
        FROM nrr_cohorts GROUP BY cohort_quarter""",
    "vq_quarter_waterfall": f"SELECT * FROM waterfall WHERE fiscal_quarter = '{FIXTURE_VERIFIED_QUARTER}'",
    "vq_growth_trend": """
        SELECT fiscal_quarter, ending_arr, net_new_arr, qoq_growth_pct
        FROM waterfall ORDER BY fiscal_quarter""",
    "vq_nrr_by_cohort": """
        SELECT cohort_quarter, fiscal_quarter, nrr_pct
        FROM nrr_cohorts ORDER BY cohort_quarter, fiscal_quarter""",
    "dq_not_null": _dq_not_null(),
    "dq_unique": _dq_unique(),
    "dq_accepted_values": _dq_accepted(),
    "dq_dedup_audit": """
        SELECT 'stg_invoices' AS table_name,
               (SELECT count(*) FROM raw_invoices) AS rows_in,
               (SELECT count(*) FROM stg_invoices) AS rows_out,
               (SELECT count(*) FROM raw_invoices) - (SELECT count(*) FROM stg_invoices)
                   AS rows_removed""",
    "dq_nrr_grain": """
        SELECT 'fct_nrr_cohorts' AS table_name,
               CAST(sum(n) AS BIGINT) AS total_rows,
               count(*) AS distinct_keys,
               count(*) FILTER (WHERE n > 1) AS duplicated_keys
        FROM (SELECT cohort_quarter, fiscal_quarter, count(*) AS n
              FROM nrr_cohorts GROUP BY cohort_quarter, fiscal_quarter) k""",
    "dq_missing_tier": """
        SELECT count(*) AS total_rows,
               count(*) FILTER (WHERE is_missing_tier) AS missing_tier_rows,
               round(CAST(count(*) FILTER (WHERE is_missing_tier) AS DOUBLE)
                     / nullif(CAST(count(*) AS DOUBLE), 0) * 100, 2) AS missing_tier_pct
        FROM stg_subscriptions""",
    "bronze_csv_waterfall": "SELECT * FROM waterfall",
    "bronze_quarantine": """
        SELECT outcome, count(*) AS rows, CAST(sum(mrr) AS DECIMAL(22,2)) AS mrr
        FROM (SELECT CASE WHEN customer_id % 143 = 0 THEN 'rejected month mrr'
                          WHEN customer_id % 11 = 0 THEN 'rejected month'
                          WHEN customer_id % 13 = 0 THEN 'rejected mrr' ELSE 'read' END AS outcome,
                     CASE WHEN customer_id % 11 <> 0 AND customer_id % 13 <> 0 THEN mrr END AS mrr
              FROM raw_subscriptions) o
        GROUP BY outcome""",
    "marts_read_back": "SELECT * FROM nrr_cohorts",
    "close_one_by_one": """
        SELECT fiscal_quarter, ending_arr,
               CAST(coalesce(beginning_arr, 0) AS BIGINT) AS beginning_arr,
               CAST(coalesce(net_new_arr, 0) AS BIGINT) AS net_new_arr,
               coalesce(qoq_growth_pct, 0.0) AS qoq_growth_pct,
               churn_arr, expansion_arr
        FROM waterfall""",
    "interval_quarter_ending": "SELECT * FROM quarter_ending",
    "interval_cohort_forward": "SELECT * FROM cohort_forward",
    "interval_cohort_starting": "SELECT * FROM cohort_starting",
    "interval_nrr_qend": "SELECT * FROM nrr_cohorts_qend",
    "late_invoices": """
        SELECT invoice_id, customer_id, invoice_date, period_month,
               CAST(date_diff('day', last_day(period_month), invoice_date) AS INTEGER) AS days_late
        FROM stg_invoices WHERE invoice_date > last_day(period_month)""",
}


def oracle_sql() -> dict[str, str]:
    return {key: PREFIX + tail for key, tail in TAILS.items()}
