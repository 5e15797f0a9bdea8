"""Tables that cut lineage, in the folder all executors share."""

from __future__ import annotations

from pyspark.sql import DataFrame

from stackroom.session import scratch_dir


def stored(df: DataFrame, purpose: str, compression: str = "snappy") -> DataFrame:
    """``df`` written as Parquet below ``spark.checkpoint.dir`` and read again.

    What is built on it does not depend on shuffle files of lost executors, and work that
    several later steps share is done once.
    """
    folder = scratch_dir(df.sparkSession, purpose)
    df.write.parquet(folder, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(folder)
