"""Declarative data-quality checks, run as Spark jobs.

Each check yields rows (table_name, column_name, check_name, failures).
``failures`` follows the usual test convention: NULL rows for not_null,
distinct duplicated values for unique, distinct unaccepted values for
accepted_values.  ``run_all`` fuses the checks of a table into one pass: a
map-side combined group-by on the unique key (or the values under test) counts
the rows and the NULLs, and a second small aggregate adds them up.  Unaccepted
values are groups that are counted, never a set held in one row, so a table
with a unique key takes a pass more for them.  ``observe_table`` counts NULLs and
rows of unaccepted values while a table is written, so that they cost no scan;
only the values of a table that has such rows are then counted apart.  ``run_not_null``, ``run_unique`` and
``run_accepted_values`` run one kind of check each.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from quarterlens.constants import MOVEMENT_TYPES, STATUSES

# The declared checks of the model, per table, in declaration order.
NOT_NULL = {
    "stg_customers": ["customer_id"],
    "stg_subscriptions": ["subscription_id", "customer_id"],
    "stg_invoices": ["invoice_id", "customer_id"],
    "stg_usage_events": ["event_id"],
    "dim_fiscal_calendar": ["month_date"],
    "dim_customers": ["customer_id"],
    "fct_arr_movements": ["customer_id", "month", "movement_type"],
    "fct_revenue_waterfall": ["fiscal_quarter"],
    "fct_nrr_cohorts": ["cohort_quarter", "fiscal_quarter"],
}
UNIQUE = {
    "stg_customers": ["customer_id"],
    "stg_subscriptions": ["subscription_id"],
    "stg_invoices": ["invoice_id"],
    "stg_usage_events": ["event_id"],
    "dim_fiscal_calendar": ["month_date"],
    "dim_customers": ["customer_id"],
    "fct_revenue_waterfall": ["fiscal_quarter"],
}
ACCEPTED_VALUES = {
    "stg_subscriptions": {"status": STATUSES},
    "fct_arr_movements": {"movement_type": MOVEMENT_TYPES},
}

#: Rows of a table of known size that one task of a uniqueness check groups.
GROUPS_A_TASK = 1_000_000

RESULT_COLUMNS = ["table_name", "column_name", "check_name", "failures"]


def _rows(table: str, check: str, counts: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Turn a one-row frame of per-column counts into long result rows."""
    pairs = ", ".join(f"'{c}', `{c}`" for c in columns)
    return counts.select(
        F.lit(table).alias("table_name"),
        F.expr(f"stack({len(columns)}, {pairs}) as (column_name, failures)"),
    ).select("table_name", "column_name", F.lit(check).alias("check_name"),
             F.col("failures").cast("bigint").alias("failures"))


def not_null(table: str, df: DataFrame, columns: Sequence[str]) -> DataFrame:
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return _rows(table, "not_null", counts, columns)


def unique(table: str, df: DataFrame, column: str, rows: int | None = None) -> DataFrame:
    """How many values occur more than once.

    Values that hardly repeat gain nothing from being combined before the
    shuffle, and a task's groups take many times the bytes it reads.  So the
    values are dealt by their hash to tasks of ``GROUPS_A_TASK`` of them or,
    if the number of ``rows`` is not known, to as many tasks as the session
    has shuffle partitions; copies of one value meet in a task, which only
    counts them.
    """
    given = df.where(F.col(column).isNotNull()).select(F.col(column).alias("value"))
    if rows is None:
        tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    else:
        tasks = max(1, -(-rows // GROUPS_A_TASK))
    # A hash of the value: by the value itself, Spark would group in the tasks of an input that has that partitioning.
    dealt = given.withColumn("hash", F.hash("value")).repartition(tasks, "hash")
    dups = dealt.groupBy("hash", "value").count().where(F.col("count") > 1)
    return _rows(table, "unique", dups.agg(F.count(F.lit(1)).alias(column)), [column])


def accepted_values(table: str, df: DataFrame, column: str,
                    values: Sequence[str]) -> DataFrame:
    bad = (df.where(F.col(column).isNotNull() & ~F.col(column).isin(*values))
           .select(column).distinct())
    return _rows(table, "accepted_values", bad.agg(F.count(F.lit(1)).alias(column)), [column])


def _union(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def run_not_null(tables: Mapping[str, DataFrame], observed: Mapping[str, Mapping[str, int]] | None = None) -> DataFrame:
    """The NULL counts; tables in ``observed`` are not read, theirs were taken while they were written."""
    observed = observed or {}
    return _union([_known_nulls(tables[t].sparkSession, t, observed[t]) if t in observed else not_null(t, tables[t], cols)
                   for t, cols in NOT_NULL.items()])


def run_unique(tables: Mapping[str, DataFrame], observed: Mapping[str, Mapping[str, int]] | None = None) -> DataFrame:
    """The duplicated keys; of tables in ``observed`` the number of rows is known."""
    observed = observed or {}
    return _union([unique(t, tables[t], c, observed.get(t, {}).get("rows")) for t, cols in UNIQUE.items() for c in cols])


def run_accepted_values(tables: Mapping[str, DataFrame]) -> DataFrame:
    return _union([accepted_values(t, tables[t], c, v)
                   for t, spec in ACCEPTED_VALUES.items() for c, v in spec.items()])


def check_table(table: str, df: DataFrame) -> DataFrame:
    """All declared checks of one table, in a single pass over it where one group-by serves them all."""
    nulls, keys = NOT_NULL.get(table, []), UNIQUE.get(table, [])
    values = ACCEPTED_VALUES.get(table, {})
    counts = [F.count_if(F.col(c).isNull()).alias(f"n_{c}") for c in nulls]
    if len(keys) > 1:
        return _union([not_null(table, df, nulls), *(unique(table, df, k) for k in keys),
                       *(accepted_values(table, df, c, v) for c, v in values.items())])
    # Values that are not the only key of the groups are grouped and counted apart.
    fused = {} if keys or len(values) > 1 else values
    apart = [accepted_values(table, df, c, v) for c, v in values.items() if c not in fused]
    # Grouping by a row's own key: for a table without one, by the values under test.
    by = keys or list(fused) or nulls[:1]
    per = df.groupBy(*(F.col(c).alias(f"k_{c}") for c in by)).agg(F.count(F.lit(1)).alias("rows"), *counts)
    total = [F.sum(f"n_{c}").alias(f"n_{c}") for c in nulls]
    total += [F.count_if((F.col("rows") > 1) & F.col(f"k_{k}").isNotNull()).alias(f"u_{k}") for k in keys]
    total += [F.count_if(~F.col(f"k_{c}").isin(*v)).alias(f"a_{c}") for c, v in fused.items()]
    names = [("not_null", c, f"n_{c}") for c in nulls] + [("unique", k, f"u_{k}") for k in keys] + \
        [("accepted_values", c, f"a_{c}") for c in fused]
    stacked = ", ".join(f"'{check}', '{column}', cast(coalesce(`{name}`, 0) as bigint)" for check, column, name in names)
    together = per.agg(*total).select(
        F.lit(table).alias("table_name"), F.expr(f"stack({len(names)}, {stacked}) as (check_name, column_name, failures)")
    ).select(*RESULT_COLUMNS)
    return _union([together, *apart])


def observe_table(table: str, df: DataFrame) -> tuple[DataFrame, Observation | None]:
    """``df`` with the declared counts observed by the action that runs it; None if the table has none.

    It has to be the top of what is written: the counts of a last stage are
    added once per task, also when a lost executor makes Spark run it again.
    """
    counts = [F.count_if(F.col(c).isNull()).alias(f"n_{c}") for c in NOT_NULL.get(table, [])]
    counts += [F.count_if(F.col(c).isNotNull() & ~F.col(c).isin(*v)).alias(f"a_{c}")
               for c, v in ACCEPTED_VALUES.get(table, {}).items()]
    if not counts:
        return df, None
    counts.append(F.count(F.lit(1)).alias("rows"))
    seen = Observation()  # a name of its own: a build that failed may have left one for the same frame
    return df.observe(seen, *counts), seen


def observed_counts(seen: Observation) -> dict[str, int] | None:
    """What was observed; None if Spark found the plan to be without rows and dropped the counting with it."""
    try:
        return seen.get
    except Py4JJavaError:
        return None


def _known_nulls(spark: SparkSession, table: str, seen: Mapping[str, int], more: Sequence[tuple] = ()) -> DataFrame:
    rows = [(table, c, "not_null", seen[f"n_{c}"]) for c in NOT_NULL.get(table, [])]
    return spark.createDataFrame([*rows, *more], "table_name string, column_name string, check_name string, failures long")


def observed_checks(table: str, df: DataFrame, seen: Mapping[str, int]) -> DataFrame:
    """All declared checks of a written table ``df`` from what was observed (``seen``) while it was written.

    NULL counts are those observed.  Unaccepted values are counted over the
    table only if rows with some were observed.  Unique keys are counted over it.
    """
    values = ACCEPTED_VALUES.get(table, {})
    fine = [(table, c, "accepted_values", 0) for c in values if not seen[f"a_{c}"]]
    known = _known_nulls(df.sparkSession, table, seen, fine)
    return _union([known, *(accepted_values(table, df, c, v) for c, v in values.items() if seen[f"a_{c}"]),
                   *(unique(table, df, c, seen.get("rows")) for c in UNIQUE.get(table, []))])


def run_all(tables: Mapping[str, DataFrame], observed: Mapping[str, Mapping[str, int]] | None = None) -> DataFrame:
    """All declared checks (14 not_null + 7 unique + 2 accepted_values), one pass per table and unfused column.

    ``observed`` has the counts of tables that were observed while they were written.
    """
    observed = observed or {}
    return _union([observed_checks(t, tables[t], observed[t]) if t in observed else check_table(t, tables[t])
                   for t in NOT_NULL])


def dedup_audit(table: str, raw: DataFrame, staged: DataFrame) -> DataFrame:
    """Rows in, rows out, rows removed by a de-duplicating stage."""
    rows_out = staged.select(F.count(F.lit(1))).scalar()  # uncorrelated scalar subquery
    return raw.agg(F.count(F.lit(1)).alias("rows_in")).select(
        F.lit(table).alias("table_name"), "rows_in", rows_out.alias("rows_out"),
        (F.col("rows_in") - rows_out).alias("rows_removed"))


def grain_check(table: str, df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows, distinct keys and keys that occur more than once."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(
        F.sum("n").cast("bigint").alias("total_rows"),
        F.count(F.lit(1)).alias("distinct_keys"),
        F.count_if(F.col("n") > 1).alias("duplicated_keys"),
    ).select(F.lit(table).alias("table_name"), "total_rows", "distinct_keys",
             "duplicated_keys")


def missing_tier_audit(subs: DataFrame) -> DataFrame:
    """How many subscription rows have no tier (excluded from ARR)."""
    return subs.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(F.col("is_missing_tier")).alias("missing_tier_rows"),
    ).select(
        "total_rows", "missing_tier_rows",
        F.round(F.col("missing_tier_rows").cast("double")
                / F.nullif(F.col("total_rows").cast("double"), F.lit(0.0)) * 100.0, 2)
        .alias("missing_tier_pct"))


def late_invoices(invoices: DataFrame) -> DataFrame:
    """Invoices dated after the last day of the month they bill."""
    month_end = F.last_day("period_month")
    return invoices.where(F.col("invoice_date") > month_end).select(
        "invoice_id", "customer_id", "invoice_date", "period_month",
        F.datediff("invoice_date", month_end).cast("int").alias("days_late"))
