"""File routing, type histograms, classification, marks."""

from __future__ import annotations

from pyspark.sql import functions as F

from stackroom.functions import json
from stackroom.operators import classify
from stackroom.queries.registry import json_text, query, table
from stackroom.sources.files import dataset_name, file_kind


@query(
    r"""
WITH f AS (
  SELECT c_custkey, '/dumps/OL_Dump ' || CASE c_mktsegment
    WHEN 'BUILDING' THEN 'Covers_Metadata' WHEN 'MACHINERY' THEN 'wikidata_ratings'
    WHEN 'FURNITURE' THEN 'Ratings' WHEN 'HOUSEHOLD' THEN 'reading-log' ELSE 'works' END
    || ' ' || c_name || CASE WHEN c_nationkey = 0 THEN '.TXT' ELSE '.txt.gz' END AS path
  FROM customer
), n AS (SELECT *, lower(split_part(path, '/', 3)) AS name FROM f)
SELECT c_custkey,
       CASE WHEN contains(name, 'covers_metadata') THEN 'covers' WHEN contains(name, 'wikidata') THEN 'wikidata'
            WHEN contains(name, 'ratings') OR contains(name, 'reading-log') THEN 'tsv' ELSE 'json' END AS kind,
       trim(regexp_replace(regexp_replace(name, '\.txt(\.gz)?$', ''), '[^a-z0-9_]+', '_', 'g'), '_') AS dataset
FROM n
"""
)
def route_files(spark, sf_dir):
    """Kind and dataset name of dump files by their names."""
    segment = F.col("c_mktsegment")
    part = (
        F.when(segment == "BUILDING", F.lit("Covers_Metadata"))
        .when(segment == "MACHINERY", F.lit("wikidata_ratings"))
        .when(segment == "FURNITURE", F.lit("Ratings"))
        .when(segment == "HOUSEHOLD", F.lit("reading-log"))
        .otherwise(F.lit("works"))
    )
    path = F.concat(
        F.lit("/dumps/OL_Dump "), part, F.lit(" "), F.col("c_name"),
        F.when(F.col("c_nationkey") == 0, F.lit(".TXT")).otherwise(F.lit(".txt.gz")),
    )
    return table(spark, sf_dir, "customer").select(
        "c_custkey", file_kind(path).alias("kind"), dataset_name(path).alias("dataset")
    )


def _typed(df, *columns, type_key):
    text = json_text(type=F.struct(type_key.alias("key")))
    return df.select(*columns, json.parse(text).alias("data"))


@query(
    """
SELECT '/type/' || event_type AS type_key, count(*) AS records
FROM events GROUP BY event_type
"""
)
def type_histogram(spark, sf_dir):
    """Record types of all rows."""
    typed = _typed(table(spark, sf_dir, "events"), type_key=F.concat(F.lit("/type/"), F.col("event_type")))
    return classify.type_histogram(typed)


_SOURCE_KINDS = """
WITH h AS (
  SELECT source, CASE lang WHEN 'en' THEN 'work' WHEN 'fr' THEN 'edition' WHEN 'de' THEN 'author' END AS kind,
         CASE lang WHEN 'en' THEN 2 WHEN 'fr' THEN 1 WHEN 'de' THEN 0 END AS priority, count(*) AS records
  FROM documents GROUP BY ALL
), best AS (
  SELECT source, arg_max(kind, records * 10 + priority) FILTER (kind IS NOT NULL) AS kind FROM h GROUP BY source
)
"""


def _source_kinds(spark, sf_dir):
    lang = F.col("lang")
    type_key = (
        F.when(lang == "en", F.lit("/type/work"))
        .when(lang == "fr", F.lit("/type/edition"))
        .when(lang == "de", F.lit("/type/author"))
        .otherwise(F.lit("/type/other"))
    )
    histogram = (
        table(spark, sf_dir, "documents")
        .select("source", type_key.alias("type_key"))
        .groupBy("source", "type_key")
        .agg(F.count(F.lit(1)).alias("records"))
    )
    return classify.classify(histogram, "source")


@query(_SOURCE_KINDS + "SELECT source, kind FROM best")
def classify_dataset(spark, sf_dir):
    """The prevailing kind of each source, languages standing for types."""
    return _source_kinds(spark, sf_dir)


@query(
    _SOURCE_KINDS
    + """
SELECT kind, string_agg(source, ',' ORDER BY source) AS datasets FROM best WHERE kind IS NOT NULL GROUP BY kind
"""
)
def datasets_by_kind(spark, sf_dir):
    grouped = classify.group_by_kind(_source_kinds(spark, sf_dir), "source")
    return grouped.select("kind", F.array_join("datasets", ",").alias("datasets"))


@query("SELECT coalesce(max(o_orderkey), 0) AS high_water_mark FROM orders")
def high_water_mark(spark, sf_dir):
    return classify.high_water_mark(table(spark, sf_dir, "orders"), "o_orderkey")
