"""Places of rows in a whole order, without one task that sees them all."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stackroom.llm.store import stored


def placed(rows: DataFrame, by: Sequence[Column], out: str) -> DataFrame:
    """``rows`` with their place from 1 in the order ``by``.

    ``rows`` should be a written table.  They are spread over ranges of the order and sorted there; a row's
    place is its own in the range and the rows of all ranges before.  A last part of the order splits
    rows that agree in the rest.
    """
    order = [*by, F.col("_salt")]
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    salted = rows.withColumn("_salt", F.xxhash64(F.monotonically_increasing_id()))
    spread = stored(
        salted.repartitionByRange(parts, *order).sortWithinPartitions(*order)
        .withColumn("_at", F.monotonically_increasing_id()),
        "placed",
    )
    # The number counts the rows of a partition in its low 33 bits.
    part, place = F.shiftright("_at", 33), F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = spread.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_rows"))
    # One row for each range.
    ahead = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_rows").over(ahead), F.lit(0)).alias("_before"))
    return (
        spread.withColumn("_part", part)
        .join(offsets, "_part")
        .withColumn(out, F.col("_before") + place + 1)
        .select(*[F.col(f"`{c}`") for c in rows.columns], out)
    )
