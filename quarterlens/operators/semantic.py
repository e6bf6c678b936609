"""A small metric-query layer over the two gold facts.

The registry describes dimensions, facts and metrics with their synonyms;
``metric`` resolves a name or synonym and runs one ``groupBy().agg()``.
Verified queries are plain projections/filters of the facts.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
import warnings

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Field:
    name: str
    column: str
    synonyms: tuple[str, ...] = ()
    # Of a fact: how it adds up. "semi" not over fiscal quarters, "ratio" not at all.
    kind: str = "additive"
    # Of a dimension: one row a value; a closed set of values, so that a filter on another one is an error.
    unique: bool = False
    enum: bool = False


@dataclass(frozen=True)
class Metric:
    name: str
    agg: str  # "sum" | "avg"
    column: str
    synonyms: tuple[str, ...] = ()
    semi_additive_over: str | None = None  # summing across this dim is meaningless


@dataclass(frozen=True)
class SemanticTable:
    name: str
    dimensions: tuple[Field, ...]
    facts: tuple[Field, ...]
    metrics: tuple[Metric, ...] = field(default_factory=tuple)


# Names and synonyms of the semantic model, in its own order.
REVENUE_WATERFALL = SemanticTable(
    name="revenue_waterfall",
    dimensions=(Field("fiscal_quarter", "fiscal_quarter", ("quarter", "period", "FQ"), unique=True, enum=True),),
    facts=(
        Field("beginning_arr", "beginning_arr", ("starting ARR", "opening ARR"), kind="semi"),
        Field("ending_arr", "ending_arr", ("final ARR", "closing ARR", "total ARR", "ARR"), kind="semi"),
        Field("net_new_arr", "net_new_arr", ("growth", "net ARR change", "net new")),
        Field("new_arr", "new_arr", ("new logo ARR", "new business", "bookings")),
        Field("expansion_arr", "expansion_arr", ("upsell ARR", "upgrade ARR", "expansion")),
        Field("contraction_arr", "contraction_arr", ("downsell ARR", "downgrade ARR",
                                                      "contraction")),
        Field("churn_arr", "churn_arr", ("churn", "lost ARR", "churned ARR", "lost revenue")),
        Field("qoq_growth_pct", "qoq_growth_pct", ("quarter over quarter growth",
                                                    "QoQ growth", "growth rate"), kind="ratio"),
    ),
    metrics=(
        Metric("ending_arr_metric", "sum", "ending_arr", ("total ARR", "ARR"),
               semi_additive_over="fiscal_quarter"),
        Metric("net_new_arr_metric", "sum", "net_new_arr", ("growth", "net new")),
        Metric("churn_arr_metric", "sum", "churn_arr", ("churn", "lost revenue")),
        Metric("expansion_arr_metric", "sum", "expansion_arr", ("expansion", "upsell")),
    ),
)

NRR_COHORTS = SemanticTable(
    name="nrr_cohorts",
    dimensions=(
        Field("cohort_quarter", "cohort_quarter", ("cohort", "signup quarter"), enum=True),
        Field("fiscal_quarter", "fiscal_quarter", ("measurement quarter", "period"), enum=True),
    ),
    facts=(Field("nrr_pct", "nrr_pct", ("retention", "NRR", "net revenue retention"), kind="ratio"),),
    metrics=(Metric("avg_nrr_pct", "avg", "nrr_pct", ("retention", "NRR", "average retention")),),
)

TABLES = (REVENUE_WATERFALL, NRR_COHORTS)


def _norm(s: str) -> str:
    return " ".join(s.lower().split())


def resolve(term: str, tables: Sequence[SemanticTable] = TABLES
            ) -> tuple[SemanticTable, Metric | Field]:
    """Find a metric or fact by name or synonym; a metric wins over a fact.

    Raises KeyError if nothing matches and ValueError if the term is
    ambiguous between tables.
    """
    t = _norm(term)
    for kind in ("metrics", "facts"):
        hits = [(tab, m) for tab in tables for m in getattr(tab, kind)
                if _norm(m.name) == t or t in {_norm(s) for s in m.synonyms}]
        if len(hits) == 1:
            return hits[0]
        if len(hits) > 1:
            raise ValueError(f"{term!r} is ambiguous: {[h[1].name for h in hits]}")
    raise KeyError(term)


def find_dimension(term: str, table: SemanticTable) -> Field:
    t = _norm(term)
    for d in table.dimensions:
        if _norm(d.name) == t or t in {_norm(s) for s in d.synonyms}:
            return d
    raise KeyError(f"{term!r} is not a dimension of {table.name}")


def resolve_dimension(term: str, table: SemanticTable) -> str:
    return find_dimension(term, table).column


def _assert_unique(df: DataFrame, table: SemanticTable) -> DataFrame:
    """``df``, failing where a unique dimension has a value twice.

    The facts have at most a row per pair of quarters, so the windows here and
    in ``_where`` are small, and they save a second run of the fact's plan.
    """
    for d in table.dimensions:
        if d.unique:
            said = F.concat(F.lit(f"{table.name} has more than one row for {d.name} "), F.col(d.column).cast("string"))
            df = df.withColumn("__rows", F.count(d.column).over(Window.partitionBy(d.column)))
            df = df.where(F.when(F.col("__rows") > 1, F.raise_error(said).cast("boolean")).otherwise(F.lit(True))) \
                .drop("__rows")
    return df


def _where(df: DataFrame, dimensions: Sequence[tuple[Field, object]], table: SemanticTable) -> DataFrame:
    """The rows with all the values, failing on one that is no member of its enumerated dimension."""
    keep = F.lit(True)
    for i, (d, value) in enumerate(dimensions):
        matches = F.col(d.column) == F.lit(value)
        if d.enum:
            df = df.withColumn(f"__found{i}", F.count_if(matches).over(Window.partitionBy()))
            said = F.lit(f"{value!r} is no {d.name} of {table.name}")
            matches = F.when(F.col(f"__found{i}") == 0, F.raise_error(said).cast("boolean")).otherwise(matches)
        keep = matches if i == 0 else keep & matches
    return df.where(keep).drop(*(f"__found{i}" for i in range(len(dimensions))))


#: The dimensions that make up each table's grain.
GRAIN = {"revenue_waterfall": {"fiscal_quarter"}, "nrr_cohorts": {"cohort_quarter", "fiscal_quarter"}}


def _check_additive(m: Metric | Field, table: SemanticTable, fixed: set[str]) -> None:
    """A fact may only be summed over dimensions that it adds up over.

    ``fixed`` holds the dimensions that the result is grouped by or that a
    filter pins to one value.
    """
    if isinstance(m, Metric):
        return
    if m.kind == "ratio" and not GRAIN[table.name] <= fixed:
        raise ValueError(f"{m.name} is a ratio: group by {sorted(GRAIN[table.name])}")
    if m.kind == "semi" and "fiscal_quarter" not in fixed:
        raise ValueError(f"{m.name} cannot be summed over quarters: group by or pick a fiscal_quarter")


def _aggregate(m: Metric | Field) -> Column:
    if isinstance(m, Metric):
        if m.agg == "sum":
            return F.sum(m.column)
        if m.agg == "avg":
            # exact decimal average of 2-decimal percentages
            return F.avg(F.col(m.column).cast("decimal(12,2)")).cast("decimal(18,6)")
        raise ValueError(m.agg)
    return F.max(m.column) if m.kind == "ratio" else F.sum(m.column)  # a ratio has one row at its grain


def metric(frames: Mapping[str, DataFrame], terms: Sequence[str] | str,
           by: Sequence[str] = (), where: Mapping[str, object] | None = None) -> DataFrame:
    """Evaluate metrics (names or synonyms) of one table grouped by dimensions.

    Running the result fails if a unique dimension of the table has a value
    twice, or if ``where`` asks for a value that an enumerated one does not have
    (a table without rows has no members to check).
    """
    terms = [terms] if isinstance(terms, str) else list(terms)
    resolved = [resolve(t) for t in terms]
    table = resolved[0][0]
    if any(r[0] is not table for r in resolved):
        raise ValueError("metrics of different tables cannot be combined")
    dims = [resolve_dimension(d, table) for d in by]
    df = _assert_unique(frames[table.name], table)
    if where:
        df = _where(df, [(find_dimension(dim, table), value) for dim, value in where.items()], table)
    aggs = []
    fixed = set(dims) | {resolve_dimension(d, table) for d in (where or {})}
    for _, m in resolved:
        _check_additive(m, table, fixed)
        semi = getattr(m, "semi_additive_over", None)
        if semi and semi not in fixed:
            warnings.warn(f"{m.name} is semi-additive over {semi}; its sum across "
                          f"{semi} values is not meaningful", stacklevel=2)
        aggs.append(_aggregate(m).alias(m.name))
    return df.groupBy(*dims).agg(*aggs)


# --- verified queries -------------------------------------------------------

def vq_quarter_waterfall(waterfall: DataFrame, fq: str) -> DataFrame:
    """The full waterfall row of one fiscal quarter."""
    return waterfall.where(F.col("fiscal_quarter") == F.lit(fq))


def vq_growth_trend(waterfall: DataFrame) -> DataFrame:
    return waterfall.select("fiscal_quarter", "ending_arr", "net_new_arr",
                            "qoq_growth_pct").orderBy("fiscal_quarter")


def vq_nrr_by_cohort(nrr: DataFrame) -> DataFrame:
    return nrr.select("cohort_quarter", "fiscal_quarter", "nrr_pct").orderBy(
        "cohort_quarter", "fiscal_quarter")
