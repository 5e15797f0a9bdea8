"""Registration of queries and the inputs they share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stackroom.session import bound_tasks, configure

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under its function name, with its SQL where there is one."""

    def register(function):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            configure(spark)
            bound_tasks(spark)
            return function(spark, sf_dir)

        QUERIES[function.__name__] = run
        if sql is not None:
            SQL[function.__name__] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str, spread_by: str | None = None) -> DataFrame:
    """A given table; ``spread_by`` names a key to deal its rows by before costly work on them.

    A file of one row group is read by one task.  The plan is the same whatever the table's size.
    """
    rows = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return rows if spread_by is None else rows.repartition(spread_by)


def json_text(**fields: Column) -> Column:
    """JSON object text; NULL fields are left out."""
    return F.to_json(F.struct(*[value.alias(name) for name, value in fields.items()]))


def placed(df: DataFrame, dataset: str, position: str) -> list[Column]:
    """Place columns for rows whose order is that of ``position``."""
    return [
        F.lit(dataset).alias("dataset"),
        F.lit(dataset).alias("source_file"),
        F.col(position).cast("bigint").alias("source_offset"),
    ]


def built_rows(df: DataFrame, *columns: Column) -> DataFrame:
    """Rows built from a table, to stand for rows read from a file.

    A plain projection would have Spark repeat the building inside every filter and use.
    """
    return df.select(F.inline(F.array(F.struct(*columns))))


def lines_of(df: DataFrame, source: str, position: str, line: Column) -> DataFrame:
    """A ``line`` column with a place, as the line source gives it."""
    return built_rows(
        df,
        F.lit(source).alias("source_file"),
        F.col(position).cast("bigint").alias("source_offset"),
        line.alias("line"),
    )


def no_time() -> Column:
    return F.lit(None).cast("timestamp_ntz")
