"""Expressions that must be evaluated once per row, and tables that must be computed once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stackroom.session import scratch_dir


def compute_once(df: DataFrame, out: str, column: Column) -> DataFrame:
    """``df`` with ``column`` added as ``out``.

    Spark evaluates a projected expression again in every filter it pushes below the
    projection.  A generated column is no such expression.
    """
    return df.select("*", F.explode(F.array(column)).alias(out))


def written(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` as a scratch table below ``spark.checkpoint.dir``, for steps that read it more than once."""
    folder = scratch_dir(df.sparkSession, purpose)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)
