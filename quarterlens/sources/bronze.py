"""The four declared bronze billing tables, read from files or a catalog.

Files are read by column name, every column as it stands, and converted here,
so that a value that does not convert is seen: it never turns into NULL.  A row
with such a value, or a line that is no record (too few or too many fields,
broken JSON), is a rejected row.  ``split_bronze`` gives, per table, the rows
that read as declared and the rejected ones with what is wrong with them; the
two add up to the input.  ``read_bronze_tables`` writes the rejected rows to a
quarantine folder or, without one, fails the query that meets one.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The declared tables and columns.
BRONZE_SCHEMAS = {
    "raw_customers": "customer_id STRING, signup_date DATE, region STRING, initial_plan_tier STRING",
    "raw_subscriptions": "subscription_id STRING, customer_id STRING, month DATE, plan_tier STRING, "
                         "mrr DECIMAL(12,2), status STRING",
    "raw_invoices": "invoice_id STRING, customer_id STRING, invoice_date DATE, period_month DATE, "
                    "amount DECIMAL(12,2)",
    "raw_usage_events": "event_id STRING, customer_id STRING, event_date DATE, event_type STRING",
}

#: Holds a line that is no record; no file column may have this name.
CORRUPT = "_corrupt_record"
REJECTED_SCHEMA = ("table_name string, problems array<struct<column_name: string, value: string>>, record string")


def _schema(name: str) -> T.StructType:
    return T.StructType.fromDDL(BRONZE_SCHEMAS[name])


def _by_name(columns: list[str], name: str) -> dict[str, str]:
    """Declared column -> the column of that name as it is spelt (case and outer blanks aside)."""
    spelt: dict[str, list[str]] = {}
    for c in columns:
        spelt.setdefault(c.strip().lower(), []).append(c)
    declared = [f.name for f in _schema(name)]
    missing = [c for c in declared if c not in spelt]
    if missing:
        raise ValueError(f"{name} lacks the columns {missing}")
    twice = [c for c in declared if len(spelt[c]) > 1]
    if twice:
        raise ValueError(f"{name} has the columns {twice} more than once")
    return {c: spelt[c][0] for c in declared}


def _declared(df: DataFrame, name: str) -> DataFrame:
    """The declared columns, cast to their types; ids keep the type they are stored in."""
    spelt = _by_name(df.columns, name)
    return df.select(*(df[spelt[f.name]].alias(f.name) if f.name.endswith("_id")
                       else df[spelt[f.name]].cast(f.dataType).alias(f.name) for f in _schema(name)))


def as_it_stands(spark: SparkSession, path: str, name: str, fmt: str,
                 options: Mapping[str, str] | None = None) -> DataFrame:
    """A file table, text formats with string columns and a column for lines that are no record."""
    options = {"header": "true", **(options or {})}
    reader = spark.read.format(fmt).options(**options)
    if fmt not in ("csv", "json"):
        return reader.load(path)
    if fmt == "csv" and options["header"] == "true":
        columns = reader.load(path).columns  # of the header line
    else:
        columns = [f.name for f in _schema(name)]
    # Every file's header has to name the columns in this order, or the read fails.
    # Without column pruning a line of another length shows whatever is selected.
    fields = ", ".join(f"`{c}` string" for c in columns)
    return (spark.read.format(fmt).options(**options).option("mode", "PERMISSIVE").option("enforceSchema", "false")
            .option("columnPruning", "false")
            .option("columnNameOfCorruptRecord", CORRUPT).schema(f"{fields}, `{CORRUPT}` string").load(path))


def _checked(df: DataFrame, name: str) -> tuple[list[Column], Column, Column]:
    """(declared columns, array of a row's problems, the row as a record) of one raw table."""
    spelt = _by_name([c for c in df.columns if c != CORRUPT], name)
    kinds = {f.name: f.dataType for f in df.schema}
    values, problems = [], [F.when(F.lit(False), F.struct(F.lit("").alias("column_name"), F.lit("").alias("value")))]
    record = F.to_json(F.struct(*(df[c] for c in spelt.values())))
    if CORRUPT in df.columns:
        problems.append(F.when(F.col(CORRUPT).isNotNull(), F.struct(
            F.lit(CORRUPT).alias("column_name"), F.col(CORRUPT).alias("value"))))
        record = F.coalesce(F.col(CORRUPT), record)
    for field in _schema(name):
        raw, kind = df[spelt[field.name]], kinds[spelt[field.name]]
        if field.name.endswith("_id") or kind == field.dataType:
            values.append(raw.alias(field.name))
            continue
        given = F.nullif(F.trim(raw), F.lit("")) if isinstance(kind, T.StringType) else raw
        value = given.try_cast(field.dataType)
        values.append(value.alias(field.name))
        problems.append(F.when(given.isNotNull() & value.isNull(), F.struct(
            F.lit(field.name).alias("column_name"), raw.cast("string").alias("value"))))
    return values, F.filter(F.array(*problems), lambda p: p.isNotNull()), record


def split_rows(df: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """(rows of the declared columns and types, rejected rows) of one raw table.

    Ids keep the type they are stored in.  A blank value is NULL, which is no
    fault here.  A rejected row has its faulty columns with their values and
    the declared columns of the record as JSON (or the line as it was read).
    """
    values, faults, record = _checked(df, name)
    return df.where(F.size(faults) == 0).select(*values), df.where(F.size(faults) > 0).select(
        F.lit(name).alias("table_name"), faults.alias("problems"), record.alias("record"))


def split_bronze(spark: SparkSession, location: str, fmt: str = "parquet",
                 options: Mapping[str, str] | None = None) -> tuple[dict[str, DataFrame], DataFrame]:
    """The four tables as declared, and the rejected rows of all of them (``REJECTED_SCHEMA``)."""
    tables, rejected = {}, None
    for name in BRONZE_SCHEMAS:
        if fmt == "table":
            raw = spark.table(f"{location}.{name}")
        else:
            raw = as_it_stands(spark, f"{location.rstrip('/')}/{name}", name, fmt, options or {})
        tables[name], bad = split_rows(raw, name)
        rejected = bad if rejected is None else rejected.unionByName(bad)
    return tables, rejected


def _or_fail(df: DataFrame, name: str) -> DataFrame:
    """The rows as declared; one that would be rejected fails the query."""
    values, faults, record = _checked(df, name)
    said = F.concat(F.lit(f"{name}: cannot read "), F.to_json(faults), F.lit(" of "), record)
    fine = F.when(F.size(faults) > 0, F.raise_error(said).cast("boolean")).otherwise(F.lit(True))
    return df.where(fine).select(*values)


def read_bronze_tables(spark: SparkSession, location: str, fmt: str = "parquet",
                       options: Mapping[str, str] | None = None, quarantine: str | None = None) -> dict[str, DataFrame]:
    """The four tables below the folder ``location``, or of the catalog schema ``location``.

    ``fmt`` is a file format of Spark (``<location>/<table>``; csv has a header
    that names the columns, in any order) or ``"table"`` (``<location>.<table>``).
    Rows that do not read as declared are written to the folder ``quarantine``
    (Parquet, ``REJECTED_SCHEMA``, one folder a table) and left out.  Without
    ``quarantine`` the first one fails the query that reads it.
    """
    options = options or {}
    if quarantine is not None:
        tables, rejected = split_bronze(spark, location, fmt, options)
        rejected.write.mode("overwrite").partitionBy("table_name").parquet(quarantine)
        return tables
    return {name: _or_fail(spark.table(f"{location}.{name}") if fmt == "table" else
                           as_it_stands(spark, f"{location.rstrip('/')}/{name}", name, fmt, options), name)
            for name in BRONZE_SCHEMAS}


def write_bronze_tables(bronze: Mapping[str, DataFrame], root: str, fmt: str = "parquet",
                        options: Mapping[str, str] | None = None) -> None:
    """Write the four tables below ``root`` (full overwrite); csv with a header.

    ``options`` go to the writer.  With ``{"compression": "gzip"}`` the text
    formats take a fraction of the space and are read back as they are; such a
    file is read by one task, so there are as many as tasks have written.
    """
    for name in BRONZE_SCHEMAS:
        _declared(bronze[name], name).write.mode("overwrite").format(fmt) \
            .options(**{"header": "true", **(options or {})}).save(f"{root.rstrip('/')}/{name}")
