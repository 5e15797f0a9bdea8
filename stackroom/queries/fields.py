"""Fields of records: keys, names, slugs, dates, subjects, covers, sources."""

from __future__ import annotations

from pyspark.sql import functions as F

from stackroom.functions import dates, json, records, text
from stackroom.operators import dedup
from stackroom.queries.registry import json_text, query, table


@query(
    r"""
WITH k AS (
  SELECT o_orderkey, CASE o_orderstatus WHEN 'O' THEN '/works/OL' || o_orderkey || 'W'
         WHEN 'F' THEN ' ol' || o_orderkey || 'm ' ELSE '/works/' || o_orderkey END AS k
  FROM orders
), n AS (
  SELECT o_orderkey, TRY_CAST(nullif(regexp_extract(trim(k), '(?i)OL([0-9]+)[A-Z]$', 1), '') AS BIGINT) AS ol_num
  FROM k
)
SELECT * FROM n WHERE ol_num > 0
"""
)
def numeric_key(spark, sf_dir):
    order, status = F.col("o_orderkey"), F.col("o_orderstatus")
    key = (
        F.when(status == "O", F.concat(F.lit("/works/OL"), order, F.lit("W")))
        .when(status == "F", F.concat(F.lit(" ol"), order, F.lit("m ")))
        .otherwise(F.concat(F.lit("/works/"), order))
    )
    keyed = table(spark, sf_dir, "orders").select("o_orderkey", text.numeric_key(key).alias("ol_num"))
    return keyed.filter(F.col("ol_num") > 0)


_SLUG = r"""
WITH s AS (
  SELECT doc_id, coalesce(nullif(trim(regexp_replace(lower(strip_accents(text)), '[^a-z0-9]+', '-', 'g'), '-'), ''),
                          doc_id::VARCHAR) AS base
  FROM documents
)
"""


@query(_SLUG + "SELECT doc_id, rtrim(left(base, 220), '-') || '-' || doc_id AS slug FROM s")
def slugify_texts(spark, sf_dir):
    """Slugs of whole texts in four languages."""
    return table(spark, sf_dir, "documents", "doc_id").select(
        "doc_id", text.entity_slug(F.col("text"), F.col("doc_id")).alias("slug")
    )


@query("SELECT doc_id, left(text, 500) AS introtext FROM documents")
def intro_text(spark, sf_dir):
    return table(spark, sf_dir, "documents", "doc_id").select(
        "doc_id", text.intro(F.col("text")).alias("introtext")
    )


@query(
    r"""
WITH p AS (
  SELECT c_custkey,
         CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN NULL
              WHEN c_mktsegment = 'FURNITURE' THEN ' ' ELSE c_name || ', ' || lower(c_mktsegment) END AS p,
         CASE WHEN c_mktsegment IN ('BUILDING', 'FURNITURE') THEN NULL
              WHEN c_acctbal < 0 THEN 'Last ' || c_custkey ELSE c_mktsegment END AS l,
         CASE WHEN c_acctbal < 1000 THEN NULL ELSE ' ' || c_name END AS n
  FROM customer
)
SELECT c_custkey,
       coalesce(nullif(concat_ws(' ', nullif(trim(p), ''),
         CASE WHEN nullif(trim(p), '') IS NULL OR NOT contains(lower(p), lower(l)) THEN l END), ''), trim(n)) AS name
FROM p
"""
)
def author_name(spark, sf_dir):
    segment, balance = F.col("c_mktsegment"), F.col("c_acctbal")
    personal = (
        F.when(segment.isin("BUILDING", "MACHINERY"), F.lit(None))
        .when(segment == "FURNITURE", F.lit(" "))
        .otherwise(F.concat("c_name", F.lit(", "), F.lower(segment)))
    )
    last = (
        F.when(segment.isin("BUILDING", "FURNITURE"), F.lit(None))
        .when(balance < 0, F.concat(F.lit("Last "), "c_custkey"))
        .otherwise(segment)
    )
    name = F.when(balance >= 1000, F.concat(F.lit(" "), "c_name"))
    parts = table(spark, sf_dir, "customer").select(
        "c_custkey",
        *[
            text.blank_to_null(value).alias(part)
            for part, value in (("personal", personal), ("last", last), ("name", name))
        ],
    )
    full = text.author_name(F.col("personal"), F.col("last"), F.col("name"))
    return parts.select("c_custkey", full.alias("name"))


_DATE_TEXT = r"""
WITH d AS (
  SELECT o_orderkey, CASE left(o_orderpriority, 1)
    WHEN '1' THEN strftime(o_orderdate, '%Y-%m-%d')
    WHEN '2' THEN 'May 3, ' || year(o_orderdate)
    WHEN '3' THEN 'c' || year(o_orderdate)
    WHEN '4' THEN year(o_orderdate) || '-51'
    ELSE year(o_orderdate) || 's' END AS t
  FROM orders
)
"""


@query(
    _DATE_TEXT
    + r"""
SELECT o_orderkey, CASE WHEN regexp_full_match(t, '[0-9]{4}-[0-9]{2}-[0-9]{2}') THEN t
  ELSE nullif(regexp_extract(t, '(?:^|[^\p{L}\p{N}_])(1[0-9]{3}|2[01][0-9]{2})(?:$|[^\p{L}\p{N}_])', 1), '')
       || '-01-01' END AS date_text
FROM d
"""
)
def year_to_date(spark, sf_dir):
    year = F.year("o_orderdate").cast("string")
    spelling = F.left(F.col("o_orderpriority"), F.lit(1))
    written = (
        F.when(spelling == "1", F.date_format("o_orderdate", "yyyy-MM-dd"))
        .when(spelling == "2", F.concat(F.lit("May 3, "), year))
        .when(spelling == "3", F.concat(F.lit("c"), year))
        .when(spelling == "4", F.concat(year, F.lit("-51")))
        .otherwise(F.concat(year, F.lit("s")))
    )
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", dates.year_or_date(written).alias("date_text")
    )


@query(
    r"""
SELECT doc_id, nullif(regexp_extract(text,
  '(?:^|[^\p{L}\p{N}_])(1[0-9]{3}|2[01][0-9]{2})(?:$|[^\p{L}\p{N}_])', 1), '') || '-01-01' AS date_text
FROM documents
"""
)
def year_in_text(spark, sf_dir):
    """First year named in a whole text."""
    return table(spark, sf_dir, "documents", "doc_id").select(
        "doc_id", dates.year_or_date(F.col("text")).alias("date_text")
    )


@query(
    r"""
SELECT event_id,
       CASE WHEN event_type IN ('signup', 'error') THEN NULL
            WHEN event_type = 'purchase' THEN date_trunc('day', ts)
            ELSE date_trunc('second', ts) END AS created_at,
       CASE WHEN event_type = 'signup' THEN NULL
            WHEN event_type = 'purchase' THEN date_trunc('day', ts)
            ELSE date_trunc('second', ts) END AS updated_at
FROM events
"""
)
def parse_datetime(spark, sf_dir):
    """Fractions, zones, days, plain text; the last change falls back to creation."""
    kind = F.col("event_type")
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    value = (
        F.when(kind == "click", F.concat(iso, F.lit(".453026")))
        .when(kind == "view", F.concat(iso, F.lit("+05:00")))
        .when(kind == "purchase", F.date_format("ts", "yyyy-MM-dd"))
        .otherwise(F.concat(iso, F.lit("Z")))
    )
    wrapped = F.struct(value.alias("value"))
    body = F.to_json(
        F.struct(
            F.when(~kind.isin("signup", "error"), wrapped).alias("created"),
            F.when(kind == "error", wrapped).alias("last_modified"),
            F.when(kind == "signup", value).alias("created_plain"),
        )
    )
    parsed = table(spark, sf_dir, "events", "event_id").select("event_id", json.parse(body).alias("d"))
    created = records.record_datetime(F.col("d"), "created")
    modified = records.record_datetime(F.col("d"), "last_modified")
    return parsed.select(
        "event_id",
        created.alias("created_at"),
        dates.updated_or_created(modified, created).alias("updated_at"),
    )


@query(
    r"""
WITH t AS (
  SELECT p_partkey, [p_type, p_name, upper(split_part(p_name, ' ', 1)), lower(p_type),
                     split_part(p_name, ' ', 1), split_part(p_name, ' ', 2)] AS texts
  FROM part
), f AS (SELECT *, list_transform(texts, lambda x: lower(x)) AS folded FROM t)
SELECT p_partkey,
       array_to_string(list_filter(texts, lambda x, i: list_position(folded, lower(x)) = i), '|') AS subjects
FROM f
"""
)
def subjects(spark, sf_dir):
    """Subjects from several keys, repeated spellings dropped, the first kept."""
    words = F.split("p_name", " ")
    first, second = F.get(words, F.lit(0)), F.get(words, F.lit(1))
    blank = F.lit("  ")
    body = json_text(
        genres=F.array(first, F.concat(second, F.lit(" "))),
        subjects=F.array(F.concat(F.lit(" "), F.col("p_type")), blank, F.col("p_name")),
        subject_people=F.array(F.lower("p_type")),
        subject_places=F.array(F.upper(first)),
        subject_times=F.col("p_size"),
    )
    parsed = table(spark, sf_dir, "part").select("p_partkey", json.parse(body).alias("d"))
    found = records.with_subjects(parsed, "d", "items")
    return found.select("p_partkey", F.array_join("items", "|").alias("subjects"))


@query(
    r"""
WITH t AS (
  SELECT l_orderkey, l_linenumber, [l_orderkey, l_partkey, -l_suppkey, l_linenumber] AS ids FROM lineitem
)
SELECT l_orderkey, l_linenumber,
       '[' || array_to_string(list_filter(ids, lambda x, i: list_position(ids, x) = i), ',') || ']' AS cover_ids
FROM t
"""
)
def cover_ids(spark, sf_dir):
    """Numbers and digit text count; fractions, words and repeats do not."""
    body = F.concat(
        F.lit('{"covers":['), F.col("l_orderkey"),
        F.lit(',"'), F.col("l_partkey"),
        F.lit('",-'), F.col("l_suppkey"),
        F.lit(","), F.col("l_quantity"),
        F.lit(',"x",null,true,'), F.col("l_linenumber"),
        F.lit(","), F.col("l_orderkey"), F.lit("]}"),
    )
    parsed = table(spark, sf_dir, "lineitem", "l_partkey").select(
        "l_orderkey", "l_linenumber", json.parse(body).alias("d")
    )
    numbers = records.cover_ids(F.col("d"), "covers")
    return parsed.select(
        "l_orderkey", "l_linenumber", records.array_text(numbers).alias("cover_ids")
    )


@query(
    r"""
WITH b AS (SELECT p_partkey, replace(p_name, ' ', '-') AS base FROM part)
SELECT p_partkey, CASE WHEN row_number() OVER (PARTITION BY base ORDER BY p_partkey) = 1
       THEN base ELSE base || '-' || p_partkey END AS slug
FROM b
"""
)
def numbered_slugs(spark, sf_dir):
    parts = table(spark, sf_dir, "part").select(
        "p_partkey", text.slugify(F.col("p_name")).alias("base")
    )
    return dedup.numbered_slugs(parts, "base", "p_partkey", ["p_partkey"]).select(
        "p_partkey", "slug"
    )


@query(
    r"""
WITH b AS (
  SELECT p_partkey AS n, CASE WHEN p_partkey % 3 = 0 THEN 'item-' || (p_partkey + 1) ELSE 'item' END AS base FROM part
), first AS (SELECT base, min(n) AS n FROM b GROUP BY base)
SELECT b.n AS number, CASE WHEN f.n IS NOT NULL THEN b.base
       WHEN EXISTS (SELECT 1 FROM b AS o WHERE o.base = b.base || '-' || b.n) THEN b.base || '--' || b.n || '-1'
       ELSE b.base || '-' || b.n END AS slug
FROM b LEFT JOIN first AS f USING (base, n)
"""
)
def numbered_slugs_beside_bases(spark, sf_dir):
    """Bases that end in other rows' numbers: every slug is still unique."""
    number = F.col("p_partkey")
    base = F.when(number % 3 == 0, F.concat(F.lit("item-"), number + 1)).otherwise("item")
    rows = table(spark, sf_dir, "part").select(number.alias("number"), base.alias("base"))
    return dedup.numbered_slugs(rows, "base", "number", ["number"]).select("number", "slug")


@query(
    r"""
SELECT customer.c_custkey, length(k) AS whole, least(length(k), 255) AS cut
FROM customer, (SELECT c_custkey, repeat('k', 250) || c_name AS k FROM customer) AS long
WHERE long.c_custkey = customer.c_custkey
"""
)
def length_limits(spark, sf_dir):
    """Keys alike in their first 255 characters stay apart; an output cuts them."""
    key = F.concat(F.repeat(F.lit("k"), 250), F.col("c_name"))
    rows = table(spark, sf_dir, "customer").select("c_custkey", key.alias("ol_key"))
    kept = dedup.keep_first(rows, ["ol_key"], ["c_custkey"])
    whole = kept.withColumn("whole", F.length("ol_key"))
    return records.cut_to_limits(whole).select("c_custkey", "whole", F.length("ol_key").alias("cut"))
