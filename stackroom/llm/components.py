"""Connected components of a graph of links, by rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stackroom.llm.store import stored

MAX_ROUNDS = 60


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node of ``links`` (a, b); the component is its smallest node.

    Alternates two steps until nothing changes: every node points its larger neighbours to its
    smallest one (large star), then its smaller neighbours and itself (small star).  The number of
    links never grows and paths shrink by half or more, so rounds grow with the logarithm of the
    longest path.  Each round is written down, which cuts lineage.
    """
    now = stored(
        links.filter(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
        "links",
    )
    before = None
    for _ in range(MAX_ROUNDS):
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        smallest = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (
            both.filter(F.col("v") > F.col("u")).join(smallest, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
        )
        large = stored(large.filter(F.col("u") != F.col("v")).distinct(), "links")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(
            F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"),
            F.col("m").alias("v"),
        )
        now = stored(small.filter(F.col("u") != F.col("v")).distinct(), "links")
        # Both steps only lower targets, so equal counts and sums mean that nothing changed.
        sums = now.agg(
            F.count("*"), F.sum(F.col("u").cast("decimal(38,0)")),
            F.sum(F.col("v").cast("decimal(38,0)")), F.bit_xor(F.xxhash64("u", "v")),
        ).first()
        if tuple(sums) == before:
            roots = now.select(F.col("v").alias("node")).distinct()
            return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                roots.select("node", F.col("node").alias("component"))
            )
        before = tuple(sums)
    raise RuntimeError(f"components are not stable after {MAX_ROUNDS} rounds")
