"""The catalog in steps: increments, streams, rebuilds, deletes and replays equal one single build.

Parts stand for works in two datasets that share keys, customers for authors.  Their records are written as
dump lines, staged and built the whole way.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stackroom import fixed_values as fixed
from stackroom.functions.json import compact
from stackroom.operators import ids, tags
from stackroom.plans import catalog, staging
from stackroom.queries.registry import json_text, query, table
from stackroom.session import scratch_dir
from stackroom.sources.files import DumpFile
from stackroom.sources.storage import list_files
from stackroom.streaming.ingest import catalog_stream

FIRST, SECOND, AUTHORS = "ol_dump_works_a", "ol_dump_works_b", "ol_dump_authors"


def _stage(spark: SparkSession, root: str, dataset: str, lines: DataFrame, kind: str = fixed.KIND_JSON) -> None:
    """Write ``line`` as dump files and stage them."""
    folder = scratch_dir(spark, "dump")
    lines.select(F.col("line").alias("value")).write.option("compression", "none").text(folder)
    files = [DumpFile(path, size, kind, dataset) for path, size in list_files(spark, folder)]
    staging.stage_dataset(spark, files, root)


def _record_line(kind: str, key, body):
    return F.concat_ws("\t", F.lit(f"/type/{kind}"), key, F.lit("1"), F.lit("2020-01-01T00:00:00"), body)


def _works(spark: SparkSession, sf_dir: str, dataset: str) -> DataFrame:
    parts = table(spark, sf_dir, "part")
    key = F.concat(F.lit("/works/OL"), F.col("p_partkey"), F.lit("W"))
    if dataset == FIRST:
        parts = parts.filter("p_partkey % 3 <> 0")
        title, subjects = F.when(F.col("p_size") % 2 == 0, F.col("p_name")), F.array("p_brand", "p_type")
    else:
        parts = parts.filter("p_partkey % 2 = 0")
        title, subjects = F.concat(F.lit("Again "), "p_name"), F.array("p_type", "p_name")
    body = json_text(type=F.struct(F.lit("/type/work").alias("key")), key=key, title=title, subjects=subjects)
    return parts.select(_record_line("work", key, body).alias("line"))


def _authors(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.concat(F.lit("/authors/OL"), F.col("c_custkey"), F.lit("A"))
    body = json_text(
        type=F.struct(F.lit("/type/author").alias("key")), key=key, name=F.col("c_name"),
        birth_date=(1800 + F.col("c_custkey") % 200).cast("string"),
        subjects=F.array("c_mktsegment"),
    )
    return table(spark, sf_dir, "customer").select(_record_line("author", key, body).alias("line"))


def _view(spark: SparkSession, root: str, way: str) -> DataFrame:
    """Entities and tag counts under one set of columns."""
    found = catalog.read_entities(spark, root).select(
        F.lit(way).alias("way"), "kind", F.col("ol_num").cast("string").alias("item"), "name",
        F.lit(None).cast("bigint").alias("items_count"),
    )
    counted = catalog.tags_with_counts(spark, root).select(
        F.lit(way).alias("way"), F.concat("kind", F.lit(" tag")).alias("kind"), F.col("slug").alias("item"),
        F.lit(None).cast("string").alias("name"), "items_count",
    )
    return found.unionByName(counted)


_WORKS = """
WITH first AS (
  SELECT p_partkey AS k, CASE WHEN p_size % 2 = 0 THEN p_name END AS title, [p_brand, p_type] AS subjects
  FROM part WHERE p_partkey % 3 <> 0 AND p_partkey > 0
), second AS (
  SELECT p_partkey AS k, 'Again ' || p_name AS title, [p_type, p_name] AS subjects
  FROM part WHERE p_partkey % 2 = 0 AND p_partkey > 0
), every AS (SELECT * FROM first UNION ALL SELECT * FROM second),
work AS (
  SELECT k, coalesce(first.title, second.title) AS name FROM first FULL JOIN second USING (k)
), tag AS (
  SELECT DISTINCT k, regexp_replace(lower(s), '[^a-z0-9]+', '-', 'g') AS slug
  FROM (SELECT k, unnest(subjects) AS s FROM every)
), works AS (
  SELECT 'work' AS kind, k::VARCHAR AS item, name, NULL::BIGINT AS items_count FROM work
  UNION ALL SELECT 'work tag', slug, NULL, count(*) FROM tag GROUP BY slug
)
"""


@query(
    _WORKS
    + "SELECT way, works.* FROM works, (VALUES ('one build'), ('increments'), ('rebuilt')) AS ways(way)"
)
def catalog_in_steps(spark, sf_dir):
    """One build of two datasets, one build after each, and a rebuild of the latter give the same."""
    whole, steps = scratch_dir(spark, "whole"), scratch_dir(spark, "steps")
    out, other = scratch_dir(spark, "catalog"), scratch_dir(spark, "catalog")
    _stage(spark, whole, FIRST, _works(spark, sf_dir, FIRST))
    _stage(spark, whole, SECOND, _works(spark, sf_dir, SECOND))
    catalog.build_catalog(spark, whole, out)
    for dataset in (FIRST, SECOND):
        _stage(spark, steps, dataset, _works(spark, sf_dir, dataset))
        catalog.build_catalog(spark, steps, other)
    # Nothing is new: the ledger says so, and nothing is written.
    if catalog.build_catalog(spark, steps, other):
        raise AssertionError("a second build read staged batches again")
    # A reader that began before the rebuild goes on with what it followed.
    views = [_view(spark, out, "one build"), _view(spark, other, "increments")]
    catalog.build_catalog(spark, steps, other, rebuild=True)
    views.append(_view(spark, other, "rebuilt"))
    return views[0].unionByName(views[1]).unionByName(views[2])


@query(
    _WORKS
    + """
SELECT 'batch, then streams' AS way, * FROM works
UNION ALL SELECT 'batch, then streams', 'author', c_custkey::VARCHAR, c_name, NULL FROM customer WHERE c_custkey > 0
UNION ALL SELECT 'batch, then streams', 'author tag', lower(c_mktsegment), NULL, count(*)
FROM customer WHERE c_custkey > 0 GROUP BY ALL
"""
)
def catalog_batch_then_streams(spark, sf_dir):
    """The plan builds one dataset; streams of three, that one included, feed the same catalog."""
    root, out = scratch_dir(spark, "staged"), scratch_dir(spark, "catalog")
    _stage(spark, root, FIRST, _works(spark, sf_dir, FIRST))
    catalog.build_catalog(spark, root, out)
    _stage(spark, root, SECOND, _works(spark, sf_dir, SECOND))
    _stage(spark, root, AUTHORS, _authors(spark, sf_dir))
    for dataset, kind in ((FIRST, "work"), (AUTHORS, "author"), (SECOND, "work")):
        for _ in range(2):  # the second run finds nothing
            catalog_stream(spark, root, dataset, kind, out, f"{out}-checkpoint-{dataset.replace('_', '-')}").awaitTermination()
    return _view(spark, out, "batch, then streams")


@query(
    """
SELECT p_partkey AS cover_id, CASE WHEN p_partkey % 2 = 0 THEN p_size ELSE p_size + 100 END AS width
FROM part WHERE p_partkey > 0 AND p_partkey % 5 <> 0
UNION ALL SELECT p_partkey, p_size + 100 FROM part WHERE p_partkey > 0 AND p_partkey % 5 = 0
"""
)
def covers_of_two_datasets(spark, sf_dir):
    """Two datasets of covers in one build: the first one's rows win, none are lost."""
    root, out = scratch_dir(spark, "staged"), scratch_dir(spark, "catalog")
    parts = table(spark, sf_dir, "part")

    def lines(rows, width):
        return rows.select(F.concat_ws("\t", "p_partkey", width, F.lit("1"), F.lit("2020-01-01")).alias("line"))

    size = F.col("p_size")
    _stage(spark, root, "ol_dump_covers_metadata_a", lines(parts.filter("p_partkey % 2 = 0 AND p_partkey % 5 <> 0"), size), fixed.KIND_COVERS)
    _stage(spark, root, "ol_dump_covers_metadata_b", lines(parts, size + 100), fixed.KIND_COVERS)
    catalog.build_catalog(spark, root, out)
    return catalog.read_catalog(spark, out, "covers").select("cover_id", "width")


_DELETES = (
    _WORKS
    + """
, gone AS (
  SELECT DISTINCT k, regexp_replace(lower(s), '[^a-z0-9]+', '-', 'g') AS slug
  FROM (SELECT k, unnest(subjects) AS s FROM first WHERE k % 5 = 0)
), live AS (SELECT * FROM tag WHERE (k, slug) NOT IN (SELECT k, slug FROM gone))
SELECT slug, count(live.k) AS items_count, count(live.k) AS recounted
FROM (SELECT DISTINCT slug FROM tag) AS t LEFT JOIN live USING (slug) GROUP BY slug
"""
)


@query(_DELETES)
def tag_counts_after_deletes(spark, sf_dir):
    """Stored counts after adds, deletes and more adds equal a full recount; what is deleted stays so."""
    root, out = scratch_dir(spark, "staged"), scratch_dir(spark, "catalog")
    _stage(spark, root, FIRST, _works(spark, sf_dir, FIRST))
    catalog.build_catalog(spark, root, out)
    links = catalog.read_catalog(spark, out, "tag_links").filter("entity_id % 5 = 0")
    stamp = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    catalog.delete_links(spark, out, links, stamp)
    catalog.delete_links(spark, out, links, stamp)  # again: changes nothing
    _stage(spark, root, SECOND, _works(spark, sf_dir, SECOND))
    catalog.build_catalog(spark, root, out)
    stored = catalog.tags_with_counts(spark, out)
    counted = tags.recount_tags(stored, catalog.read_catalog(spark, out, "tag_links"))
    return stored.select("slug", "items_count").join(
        counted.select("slug", F.col("items_count").alias("recounted")), "slug"
    )


@query(
    """
SELECT 'with' AS target, c_custkey AS ol_num, c_name AS name, (1800 + c_custkey % 200) || '-01-01' AS birth_date
FROM customer WHERE c_custkey > 0
UNION ALL SELECT 'without', c_custkey, NULL, NULL FROM customer WHERE c_custkey > 0
"""
)
def kind_tables_adapted(spark, sf_dir):
    """Author tables of a target with the optional columns and of one without."""
    root, out = scratch_dir(spark, "staged"), scratch_dir(spark, "catalog")
    _stage(spark, root, AUTHORS, _authors(spark, sf_dir))
    catalog.build_catalog(spark, root, out)
    least = ["ol_num", "site_id", "category_id", "status"]
    rows = []
    for target, more in (("with", ["name", "birth_date", "death_date"]), ("without", [])):
        folder = scratch_dir(spark, "target")
        catalog.write_kind_tables(spark, out, {"author": {"entities": [*least, *more]}}, folder)
        written = spark.read.parquet(f"{folder}/author_entities")
        if set(written.columns) != {*least, *more}:
            raise AssertionError(f"columns {written.columns}")
        optional = [
            F.col(c) if c in written.columns else F.lit(None).cast("string").alias(c) for c in ("name", "birth_date")
        ]
        rows.append(written.select(F.lit(target).alias("target"), "ol_num", *optional))
    return rows[0].unionByName(rows[1])


@query(
    """
SELECT count(*) AS keys, count(*) AS ids, (SELECT count(DISTINCT p_brand) FROM part) AS kept
FROM (SELECT DISTINCT p_brand FROM part UNION SELECT DISTINCT p_type FROM part)
"""
)
def ids_after_clash(spark, sf_dir):
    """Ids cut to a few bits clash; every key gets one of its own, and earlier ones stay as they are."""
    parts = table(spark, sf_dir, "part")
    id_of = ids.hashed(["slug"], bits=8)
    old = ids.settled(parts.select(F.col("p_brand").alias("slug")).distinct(), None, "id", ["slug"], id_of)
    new = parts.select(F.col("p_type").alias("slug")).distinct().join(old, "slug", "left_anti")
    every = old.unionByName(ids.settled(new, old, "id", ["slug"], id_of))
    same = every.join(old.select("slug", F.col("id").alias("old")), "slug", "left")
    return same.agg(
        F.count(F.lit(1)).alias("keys"), F.countDistinct("id").alias("ids"),
        F.count_if(F.col("id") == F.col("old")).alias("kept"),
    )


@query(
    """
SELECT way, 'E' || event_id AS wd_id, '{"id":"E' || event_id || '","kind":"' || event_type || '"}' AS canonical
FROM events, (VALUES ('replayed'), ('relaxed')) AS ways(way)
"""
)
def replayed_rejects(spark, sf_dir):
    """Lines a rule rejects, kept raw and parsed again by a relaxed rule, give what that rule gives at once."""
    key = F.concat(F.lit("E"), F.col("event_id"))
    body = json_text(id=key, kind=F.col("event_type"))
    quoted = F.concat(F.lit('"'), F.replace(body, F.lit('"'), F.lit('""')), F.lit('"'))
    # Every third line has text before its JSON, which only the lenient rule forgives.
    text = F.when(F.col("event_id") % 3 == 0, F.concat(F.lit("see "), body)).otherwise(quoted)
    folder = scratch_dir(spark, "dump")
    table(spark, sf_dir, "events").select(F.concat_ws("\t", key, text).alias("value")).write.option("compression", "none").text(folder)
    dataset = "ol_dump_wikidata"
    files = [DumpFile(path, size, fixed.KIND_WIKIDATA, dataset) for path, size in list_files(spark, folder)]
    strict, relaxed = scratch_dir(spark, "strict"), scratch_dir(spark, "relaxed")
    staging.stage_dataset(spark, files, strict)
    staging.replay_rejects(
        spark, strict, dataset, fixed.KIND_WIKIDATA,
        lambda lines: staging.parse_lines(lines, fixed.KIND_WIKIDATA, lenient=True),
    )
    staging.stage_dataset(spark, files, relaxed, lenient=True)
    rows = [
        staging.read_staged(spark, root, dataset, fixed.KIND_WIKIDATA).select(
            F.lit(way).alias("way"), "wd_id", compact(F.col("data")).alias("canonical")
        )
        for way, root in (("replayed", strict), ("relaxed", relaxed))
    ]
    return rows[0].unionByName(rows[1])
