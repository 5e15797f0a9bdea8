"""Which row of a key counts."""

from __future__ import annotations

from pyspark.sql import functions as F

from stackroom.operators import dedup
from stackroom.operators.covers import build_covers, new_covers
from stackroom.operators.entities import union_datasets
from stackroom.queries.catalog import item_offset
from stackroom.queries.registry import placed, query, table

_FIRST_DOCUMENTS = "SELECT min(doc_id) AS doc_id, md5(text) AS text_hash FROM documents GROUP BY text"


@query(_FIRST_DOCUMENTS)
def keep_first_documents(spark, sf_dir):
    """The first document of every text."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup.keep_first(documents, ["text"], ["doc_id"]).select(
        "doc_id", F.md5("text").alias("text_hash")
    )


@query(_FIRST_DOCUMENTS)
def keep_first_wide_documents(spark, sf_dir):
    """The same through the duplicated keys only; texts compare by a long hash."""
    documents = table(spark, sf_dir, "documents").select(
        "doc_id", "text", F.sha2("text", 256).alias("text_key")
    )
    return dedup.keep_first_wide(documents, ["text_key"], ["doc_id"]).select(
        "doc_id", F.md5("text").alias("text_hash")
    )


@query(
    """
SELECT event_id, CASE WHEN event_type = 'view' THEN NULL ELSE user_id END AS user_key FROM events
QUALIFY event_type = 'view' OR row_number() OVER (
  PARTITION BY event_type = 'view', user_id ORDER BY event_id) = 1
"""
)
def keep_first_null_exempt(spark, sf_dir):
    """Rows without a key are no duplicates of each other."""
    keyed = table(spark, sf_dir, "events").select(
        "event_id", F.when(F.col("event_type") != "view", F.col("user_id")).alias("user_key")
    )
    return dedup.keep_first(keyed, ["user_key"], ["event_id"])


@query(
    """
SELECT user_id, arg_min(value, event_id) AS value,
       coalesce(arg_min(event_type, event_id) FILTER (event_type <> 'view'), arg_min('', event_id)) AS name,
       coalesce(arg_min(ts, event_id) FILTER (event_type <> 'view'), arg_min(ts, event_id)) AS updated_at
FROM events GROUP BY user_id
"""
)
def first_wins_backfill(spark, sf_dir):
    """First event per user; views have no name, the next named event supplies it."""
    rows = table(spark, sf_dir, "events").select(
        "user_id",
        "event_id",
        "value",
        F.when(F.col("event_type") == "view", F.lit("")).otherwise(F.col("event_type")).alias("name"),
        F.col("ts").alias("updated_at"),
    )
    return dedup.first_wins_backfill(rows, ["user_id"], ["event_id"]).drop("event_id")


@query(
    """
SELECT key, arg_min(name, rank) AS name, arg_min(dataset, rank) AS dataset FROM (
  SELECT c_custkey AS key, c_name AS name, 'customer' AS dataset, 0 AS rank FROM customer
  UNION ALL SELECT s_suppkey, s_name, 'supplier', 1 FROM supplier
) GROUP BY key
"""
)
def union_sources(spark, sf_dir):
    """Customers and suppliers share numbers; the earlier dataset wins."""
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("key"), F.col("c_name").alias("name")
    )
    suppliers = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("key"), F.col("s_name").alias("name")
    )
    rows = union_datasets([("customer", customers), ("supplier", suppliers)])
    return dedup.keep_first(rows, ["key"], ["dataset", "name"])


_LINE_COVERS = """
WITH item AS (
  SELECT *, l_orderkey * 1000000000 + l_linenumber * 100000000 + round(l_extendedprice * 100)::BIGINT AS place
  FROM lineitem WHERE l_partkey > 0
)
SELECT l_partkey AS cover_id, arg_min(l_quantity::INTEGER, place) AS width,
       arg_min(l_linenumber, place) AS height
FROM item GROUP BY l_partkey
"""


def _line_covers(spark, sf_dir):
    items = table(spark, sf_dir, "lineitem")
    return build_covers(
        items.select(
            F.col("l_partkey").alias("cover_id"),
            F.col("l_quantity").cast("int").alias("width"),
            F.col("l_linenumber").alias("height"),
            F.col("l_orderkey").alias("source_file"),
            item_offset().alias("source_offset"),
        )
    )


@query(_LINE_COVERS)
def covers_catalog(spark, sf_dir):
    """Every line item as a cover of its part: many repeats, the first kept."""
    return _line_covers(spark, sf_dir).select("cover_id", "width", "height")


@query(
    """
SELECT p_partkey AS cover_id, p_size AS width FROM part
WHERE p_partkey > 0 AND NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = p_partkey)
"""
)
def late_covers(spark, sf_dir):
    """Covers that are not there yet, in whatever order their numbers arrive."""
    existing = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("cover_id"))
    part = table(spark, sf_dir, "part")
    staged = part.select(
        *placed(part, "part", "p_partkey"),
        F.col("p_partkey").alias("cover_id"),
        F.col("p_size").alias("width"),
        F.col("p_size").alias("height"),
    )
    return new_covers(existing, build_covers(staged)).select("cover_id", "width")


@query(
    """
SELECT arg_min(event_id, event_id) AS event_id, lower(event_type) AS type_key FROM events GROUP BY 2
"""
)
def keep_first_collated(spark, sf_dir):
    """First event per type, the types written in two cases that count as equal."""
    mixed = table(spark, sf_dir, "events").select(
        "event_id",
        F.when(F.col("value") > 10, F.upper("event_type"))
        .otherwise(F.col("event_type"))
        .alias("type_name"),
    )
    first = dedup.keep_first(mixed, ["type_name"], ["event_id"], collation="UNICODE_CI_AI")
    return first.select("event_id", F.lower("type_name").alias("type_key"))
