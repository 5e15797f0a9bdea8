"""Tags, links and counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stackroom.functions.records import split_sources
from stackroom.functions.text import strip
from stackroom.operators import sources, tags
from stackroom.queries.registry import no_time, placed, query, table

_PART_TAGS = """
WITH subject AS (
  SELECT p_partkey,
         unnest(list_concat([p_type, p_brand], string_split(p_name, ' '))) AS name,
         generate_subscripts(list_concat([p_type, p_brand], string_split(p_name, ' ')), 1) AS ord
  FROM part
), tag AS (
  SELECT p_partkey, name, ord,
         nullif(trim(regexp_replace(lower(name), '[^a-z0-9]+', '-', 'g'), '-'), '') AS slug
  FROM subject
)
"""


def part_records(spark: SparkSession, sf_dir: str, subjects) -> DataFrame:
    """Parts as records: the key is the number, ``subjects`` the tags."""
    part = table(spark, sf_dir, "part")
    return part.select(
        F.lit("work").alias("kind"),
        F.col("p_partkey").alias("ol_num"),
        *placed(part, "part", "p_partkey"),
        subjects.alias("subjects"),
        no_time().alias("created_at"),
        no_time().alias("updated_at"),
    )


def _part_subjects():
    return F.concat(F.array("p_type", "p_brand"), F.split("p_name", " "))


@query(
    _PART_TAGS
    + """
SELECT slug, arg_min(name, p_partkey * 1000 + ord) AS name,
       count(DISTINCT p_partkey) AS items_count
FROM tag WHERE slug IS NOT NULL GROUP BY slug
"""
)
def tag_counts(spark, sf_dir):
    """How many items carry each tag."""
    exploded = tags.explode_tags(part_records(spark, sf_dir, _part_subjects()))
    counted = tags.recount_tags(tags.build_tags(exploded), tags.build_links(exploded))
    return counted.select("slug", "name", "items_count")


@query(
    _PART_TAGS
    + """
SELECT slug, arg_min(name, p_partkey * 1000 + ord) AS name
FROM tag WHERE slug IS NOT NULL GROUP BY slug
"""
)
def tag_dimension(spark, sf_dir):
    exploded = tags.explode_tags(part_records(spark, sf_dir, _part_subjects()))
    return tags.build_tags(exploded).select("slug", "name")


@query(
    _PART_TAGS
    + "SELECT DISTINCT p_partkey AS entity_id, slug FROM tag WHERE slug IS NOT NULL"
)
def tag_links(spark, sf_dir):
    """Links through the tag table, as for tags with ids of their own."""
    exploded = tags.explode_tags(part_records(spark, sf_dir, _part_subjects()))
    dimension = tags.build_tags(exploded)
    links = tags.links_to_known_tags(exploded, dimension)
    return links.join(dimension.select("tag_id", "slug"), "tag_id").select("entity_id", "slug")


@query(
    _PART_TAGS
    + """
SELECT DISTINCT slug FROM tag
WHERE slug IS NOT NULL AND slug NOT IN (
  SELECT slug FROM tag WHERE ord > 2 AND slug IS NOT NULL)
"""
)
def missing_tags(spark, sf_dir):
    """Tags of parts that no word of a part name gives."""
    wanted = tags.explode_tags(part_records(spark, sf_dir, _part_subjects()))
    existing = tags.explode_tags(part_records(spark, sf_dir, F.split("p_name", " ")))
    found = tags.missing_tags(tags.build_tags(wanted), tags.build_tags(existing))
    return found.select("slug")


@query(
    """
SELECT n_name AS slug, coalesce(c, 0) AS items_count
FROM nation LEFT JOIN (
  SELECT s_nationkey, count(*) AS c FROM supplier GROUP BY s_nationkey
) ON n_nationkey = s_nationkey
"""
)
def zero_counts(spark, sf_dir):
    """Suppliers per nation; nations without suppliers count zero."""
    return _nation_counts(
        spark, sf_dir, table(spark, sf_dir, "supplier"), "s_nationkey", "s_suppkey", no_time()
    )


@query(
    """
SELECT n_name AS slug, coalesce(c, 0) AS items_count
FROM nation LEFT JOIN (
  SELECT c_nationkey, count(*) AS c FROM customer WHERE NOT c_acctbal < 0 GROUP BY c_nationkey
) ON n_nationkey = c_nationkey
"""
)
def live_link_counts(spark, sf_dir):
    """Customers per nation; those in debt count as deleted links."""
    deleted = F.when(F.col("c_acctbal") < 0, F.lit("2000-01-01").cast("timestamp_ntz"))
    return _nation_counts(
        spark, sf_dir, table(spark, sf_dir, "customer"), "c_nationkey", "c_custkey", deleted
    )


def _nation_counts(spark, sf_dir, items, nation_key, item_key, deleted_at):
    dimension = table(spark, sf_dir, "nation").select(
        F.lit("work").alias("kind"),
        F.col("n_nationkey").cast("bigint").alias("tag_id"),
        F.col("n_name").alias("slug"),
        F.lit(0).cast("bigint").alias("items_count"),
    )
    links = items.select(
        F.lit("work").alias("kind"),
        F.col(item_key).alias("entity_id"),
        F.col(nation_key).cast("bigint").alias("tag_id"),
        deleted_at.alias("deleted_at"),
    )
    return tags.recount_tags(dimension, links).select("slug", "items_count")


@query(
    r"""
WITH word AS (
  SELECT doc_id, unnest(regexp_split_to_array(text, '[ \t\n\r]+')) AS name FROM documents
), tag AS (
  SELECT doc_id, nullif(trim(regexp_replace(lower(strip_accents(name)), '[^a-z0-9]+', '-', 'g'), '-'), '') AS slug
  FROM word
)
SELECT slug, count(DISTINCT doc_id) AS items_count
FROM tag WHERE slug IS NOT NULL GROUP BY slug
"""
)
def document_word_counts(spark, sf_dir):
    """Every word of every document as a tag: many links, a few very popular tags."""
    documents = table(spark, sf_dir, "documents", "doc_id")
    recs = documents.select(
        F.lit("work").alias("kind"),
        F.col("doc_id").alias("ol_num"),
        *placed(documents, "documents", "doc_id"),
        # Repeated words of one text make one link; drop them before exploding.
        F.array_distinct(F.split("text", r"[ \t\n\r]+")).alias("subjects"),
        no_time().alias("created_at"),
        no_time().alias("updated_at"),
    )
    exploded = tags.explode_tags(recs)
    counted = tags.recount_tags(tags.build_tags(exploded), tags.build_links(exploded))
    return counted.select("slug", "items_count")


_PAGE_SOURCES = """
WITH pair AS (
  SELECT page_id, trim(split_part(url, ':', 1)) AS source,
         trim(substr(url, instr(url, ':') + 1)) AS source_key
  FROM pages WHERE instr(url, ':') > 0
)
"""


def page_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    urls = F.transform(F.array("url"), strip)
    return pages.select(
        F.lit("edition").alias("kind"),
        F.col("page_id").alias("ol_num"),
        *placed(pages, "pages", "page_id"),
        split_sources(urls).alias("source_records"),
        no_time().alias("created_at"),
        no_time().alias("updated_at"),
    )


@query(_PAGE_SOURCES + "SELECT DISTINCT source, source_key FROM pair WHERE source_key <> ''")
def source_records(spark, sf_dir):
    exploded = sources.explode_sources(page_records(spark, sf_dir))
    return sources.build_source_records(exploded).select("source", "source_key")


@query(
    _PAGE_SOURCES
    + """
SELECT DISTINCT source, source_key, 'edition' AS entity_type, page_id AS entity_id
FROM pair WHERE source_key <> ''
"""
)
def source_links(spark, sf_dir):
    """Links to source records, their ids looked up by natural key."""
    exploded = sources.explode_sources(page_records(spark, sf_dir))
    known = sources.build_source_records(exploded)
    links = sources.links_to_known_records(exploded, known)
    named = links.join(known.select("source_record_id", *sources.SOURCE_KEYS), "source_record_id")
    return named.select("source", "source_key", "entity_type", "entity_id")


@query(
    _PAGE_SOURCES
    + """
SELECT source, count(DISTINCT source_key) AS records, count(DISTINCT page_id) AS entities
FROM pair WHERE source_key <> '' GROUP BY source
"""
)
def source_totals(spark, sf_dir):
    """Records and linked entities per source, counted from the distinct links."""
    exploded = sources.explode_sources(page_records(spark, sf_dir))
    return exploded.groupBy("source").agg(
        F.countDistinct("source_key").alias("records"),
        F.countDistinct("entity_id").alias("entities"),
    )
