"""Warehouse tables: conform to the contract, create, load, check."""

from __future__ import annotations

import warnings
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.errors import AnalysisException

from delinq import schemas
from delinq.functions.numeric import nan_to_null
from delinq.operators.portfolio import table_counts
from delinq.sources.files import read_csv

DATE_TEXT = "yyyy-MM-dd HH:mm:ss"

# One row per borrower: only these can be clustered by borrower. Loans and payments cannot: a
# bucket is one task, and one borrower may hold any share of their rows.
ONE_ROW_PER_BORROWER = [n for n in schemas.TABLES if n not in ("student_loan_loans", "student_loan_payments")]


@dataclass(frozen=True)
class ColumnReport:
    missing: list[str]
    extra: list[str]


def column_report(df: DataFrame, schema: T.StructType) -> ColumnReport:
    return ColumnReport(
        missing=sorted(set(schema.names) - set(df.columns)),
        extra=sorted(set(df.columns) - set(schema.names)),
    )


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Keep the expected columns in contract order and type; NaN becomes NULL.

    Dates are text in the contract. Missing columns are left out, extra ones dropped;
    ``column_report`` names both.
    """
    columns = []
    for field in schema:
        if field.name not in df.columns:
            continue
        source = df.schema[field.name].dataType
        column = F.col(field.name)
        if isinstance(field.dataType, T.StringType) and isinstance(
            source, (T.TimestampType, T.TimestampNTZType, T.DateType)
        ):
            column = F.date_format(column, DATE_TEXT)
        columns.append(column.cast(field.dataType).alias(field.name))
    return nan_to_null(df.select(*columns))


def row_cap(df: DataFrame, key: str, n: int = 100) -> DataFrame:
    """The first n rows by key: the demo load of a table."""
    return df.orderBy(key).limit(n)


def recreate_database(spark: SparkSession, database: str, location: str | None = None) -> None:
    spark.sql(f"DROP DATABASE IF EXISTS `{database}` CASCADE")
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE `{database}`{where}")


def create_table(spark: SparkSession, database: str, name: str) -> None:
    """An empty table with the contract columns."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schemas.TABLES[name])
    spark.sql(f"CREATE TABLE `{database}`.`{name}` ({columns}) USING parquet")


def load_table(
    df: DataFrame, database: str, name: str, cap: int | None = None, buckets: int | None = None
) -> ColumnReport:
    """Write one table in a single distributed job.

    ``buckets`` clusters the tables with one row per borrower: joins between them then need no
    shuffle. ``cap`` is the demo row cap.
    """
    clustered = buckets is not None and name in ONE_ROW_PER_BORROWER
    schema = schemas.TABLES[name]
    report = column_report(df, schema)
    if report.missing or report.extra:
        warnings.warn(f"{name}: missing {report.missing}, extra {report.extra}", stacklevel=2)
    out = conform(df, schema)
    if cap is not None:
        out = row_cap(out, schema.names[0], cap)
    if clustered:
        out = out.repartition(buckets, "borrower_id")
    writer = out.write.mode("overwrite").format("parquet")
    if clustered:
        writer = writer.bucketBy(buckets, "borrower_id").sortBy("borrower_id")
    writer.saveAsTable(f"`{database}`.`{name}`")
    return report


def load_csv_tables(
    spark: SparkSession, database: str, paths: dict[str, str], cap: int | None = 100
) -> dict[str, ColumnReport]:
    """Load CSV files into their tables; a missing or empty file is skipped with a warning."""
    reports = {}
    for name, path in paths.items():
        try:
            df = read_csv(spark, path, schemas.TABLES[name])
        except AnalysisException:
            warnings.warn(f"{name}: {path} not found, skipped", stacklevel=2)
            continue
        if not df.columns or df.isEmpty():
            warnings.warn(f"{name}: no data in {path}, skipped", stacklevel=2)
            continue
        reports[name] = load_table(df, database, name, cap)
    return reports


def load_all(
    spark: SparkSession,
    database: str,
    frames: dict[str, DataFrame],
    location: str | None = None,
    cap: int | None = None,
    buckets: int | None = None,
) -> DataFrame:
    """Recreate the database with all tables, load what is given, return the row counts."""
    recreate_database(spark, database, location)
    for name in schemas.TABLES:
        create_table(spark, database, name)
    for name, df in frames.items():
        load_table(df, database, name, cap, buckets)
    return database_summary(spark, database)


def database_summary(spark: SparkSession, database: str) -> DataFrame:
    """Row count per table of the database, and the total."""
    names = sorted(t.name for t in spark.catalog.listTables(database) if not t.isTemporary)
    return table_counts(**{name: spark.table(f"`{database}`.`{name}`") for name in names})


def verify_load(spark: SparkSession, database: str, expected: dict[str, int]) -> DataFrame:
    """Expected against actual rows per table."""
    actual = database_summary(spark, database)
    pairs = [F.struct(F.lit(n).alias("table_name"), F.lit(c).cast("bigint").alias("expected_rows")) for n, c in expected.items()]
    wanted = spark.range(1).select(F.inline(F.array(*pairs)))
    return wanted.join(actual, "table_name", "left").select(
        "table_name",
        "expected_rows",
        F.coalesce("row_count", F.lit(0)).alias("row_count"),
        (F.coalesce("row_count", F.lit(0)) == F.col("expected_rows")).alias("complete"),
    )
