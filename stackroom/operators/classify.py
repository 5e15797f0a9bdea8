"""Which kind of record a dataset holds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stackroom import fixed_values as fixed
from stackroom.functions.records import record_type


def type_histogram(records: DataFrame) -> DataFrame:
    """Records per type key, for records whose type is text."""
    typed = records.select(record_type(F.col("data")).alias("type_key"))
    return typed.filter(F.col("type_key").isNotNull()).groupBy("type_key").agg(
        F.count(F.lit(1)).alias("records")
    )


def kind_of_type(type_key: Column) -> Column:
    kind = F.lit(None).cast("string")
    for key, name in fixed.TYPE_TO_KIND:
        kind = F.when(type_key == key, name).otherwise(kind)
    return kind


def _rank(kind: Column) -> Column:
    rank = F.lit(None).cast("int")
    for place, (_, name) in enumerate(fixed.TYPE_TO_KIND):
        rank = F.when(kind == name, place).otherwise(rank)
    return rank


def classify(histogram: DataFrame, *by: str) -> DataFrame:
    """The most frequent known kind per ``by``; NULL when no known type occurs.

    Ties go to work, then edition, then author.
    """
    kinds = histogram.withColumn("kind", kind_of_type(F.col("type_key")))
    known = F.col("kind").isNotNull() & (F.col("records") > 0)
    score = F.when(known, F.struct(F.col("records"), -_rank(F.col("kind"))))
    return kinds.groupBy(*by).agg(F.max_by("kind", score).alias("kind"))


def group_by_kind(classified: DataFrame, dataset: str = "dataset") -> DataFrame:
    """Dataset names per kind, in name order.  One row per dataset goes in."""
    return (
        classified.filter(F.col("kind").isNotNull())
        .groupBy("kind")
        .agg(F.array_sort(F.collect_list(dataset)).alias("datasets"))
    )


def high_water_mark(df: DataFrame, column: str) -> DataFrame:
    """Largest value of ``column``, 0 for an empty input."""
    return df.agg(F.coalesce(F.max(column), F.lit(0)).alias("high_water_mark"))


def after_mark(df: DataFrame, column: str, mark: int, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows after ``mark``; the filter and the columns reach the file scan."""
    rows = df.filter(F.col(column) > mark)
    return rows.select(*columns) if columns else rows
