"""Dump lines built from the tables, and what the readers make of them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from stackroom.functions import json, tsv
from stackroom.functions.text import strip
from stackroom.operators import covers, parse
from stackroom.operators.classify import after_mark, high_water_mark
from stackroom.queries.registry import json_text, lines_of, query, table


def event_line() -> Column:
    """type, key, revision, time, JSON; the JSON of errors is cut short."""
    body = F.concat(
        F.lit('{"key":"/events/OL'), F.col("event_id"), F.lit('W","props":'), F.col("props"), F.lit("}")
    )
    broken = F.substr(body, F.lit(1), F.char_length(body) - 1)
    return F.concat_ws(
        "\t",
        F.concat(F.lit("/type/"), F.col("event_type")),
        F.concat(F.lit("/events/OL"), F.col("event_id"), F.lit("W")),
        F.col("user_id").cast("string"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"),
        F.when(F.col("event_type") == "error", broken).otherwise(body),
    )


_EVENT_LINE = """
WITH body AS (
  SELECT *, '{"key":"/events/OL' || event_id || 'W","props":' || props || '}' AS j FROM events
), line AS (
  SELECT event_id, event_type,
         '/type/' || event_type || chr(9) || '/events/OL' || event_id || 'W' || chr(9) || user_id
         || chr(9) || strftime(ts, '%Y-%m-%dT%H:%M:%S') || chr(9)
         || CASE WHEN event_type = 'error' THEN left(j, length(j) - 1) ELSE j END AS line
  FROM body
), located AS (
  SELECT *, substr(line, instr(line, '{')) AS data_json,
         list_transform(string_split(line, chr(9)), lambda f: trim(f)) AS fields
  FROM line
)
"""


@query(
    _EVENT_LINE
    + r"""
SELECT event_id AS source_offset, json_extract_string(data_json, '$.key') AS ol_key,
       CAST(list_filter(fields, lambda f: regexp_full_match(f, '[0-9]+'))[1] AS INTEGER) AS revision,
       list_filter(fields, lambda f: f <> '' AND length(f) <= 64)[-1] AS last_modified,
       CAST(json(data_json) AS VARCHAR) AS canonical
FROM located WHERE json_valid(data_json)
"""
)
def parse_record_line(spark, sf_dir):
    lines = lines_of(table(spark, sf_dir, "events", "event_id"), "events", "event_id", event_line())
    return parse.accepted(parse.json_records(lines)).select(
        "source_offset", "ol_key", "revision", "last_modified",
        json.compact(F.col("data")).alias("canonical"),
    )


@query(
    r"""
WITH j AS (
  SELECT event_id, CAST(CASE event_type
    WHEN 'click' THEN '{"f":" click "}'
    WHEN 'view' THEN '{"f":{"value":"' || user_id || '"}}'
    WHEN 'error' THEN '{"f":' || props || '}'
    WHEN 'signup' THEN '{"f":["a"]}'
    ELSE '{"f":' || user_id || '}' END AS JSON) AS d
  FROM events
)
SELECT event_id,
       CASE WHEN json_type(d, '$.f') = 'VARCHAR' THEN json_extract_string(d, '$.f') END AS plain_text,
       CASE WHEN json_type(d, '$.f') = 'VARCHAR' THEN nullif(trim(json_extract_string(d, '$.f')), '')
            WHEN json_type(d, '$.f.value') = 'VARCHAR'
            THEN nullif(trim(json_extract_string(d, '$.f.value')), '') END AS text_or_value,
       CAST(json_extract(json_extract_string(d, '$.f.k'), '$') AS BIGINT) AS number
FROM j
"""
)
def json_field_guard(spark, sf_dir):
    """Text, object, list and number under one key."""
    events = table(spark, sf_dir, "events", "event_id")
    kind = F.col("event_type")
    text = (
        F.when(kind == "click", F.lit('{"f":" click "}'))
        .when(kind == "view", F.concat(F.lit('{"f":{"value":"'), "user_id", F.lit('"}}')))
        .when(kind == "error", F.concat(F.lit('{"f":'), "props", F.lit("}")))
        .when(kind == "signup", F.lit('{"f":["a"]}'))
        .otherwise(F.concat(F.lit('{"f":'), "user_id", F.lit("}")))
    )
    found = events.select("event_id", json.parse(text).alias("d"))
    return found.select(
        "event_id",
        json.text_at(F.col("d"), "f").alias("plain_text"),
        json.text_or_value(F.col("d"), "f").alias("text_or_value"),
        json.as_digits(json.field(F.col("d"), "f", "k")).try_cast("bigint").alias("number"),
    )


@query(
    r"""
SELECT doc_id, md5(regexp_replace(regexp_replace(text, '^\s+', ''), '\s+$', '')) AS text_hash,
       text AS ol_key
FROM documents
"""
)
def json_text_intact(spark, sf_dir):
    """Whole texts through JSON: quotes, line breaks and other escapes survive."""
    documents = table(spark, sf_dir, "documents", "doc_id")
    line = F.concat_ws("\t", F.lit("/type/work"), json_text(key=F.col("text"), title=F.col("text")))
    parsed = parse.accepted(parse.json_records(lines_of(documents, "documents", "doc_id", line)))
    return parsed.select(
        F.col("source_offset").alias("doc_id"),
        F.md5(json.text_or_value(F.col("data"), "title")).alias("text_hash"),
        "ol_key",
    )


_REASONS = """
WITH reason AS (
  SELECT event_id, CASE event_type WHEN 'view' THEN 'empty_line' WHEN 'signup' THEN 'no_json'
                   WHEN 'error' THEN 'bad_json' END AS reject_reason
  FROM events
)
"""


def _defective_lines(spark, sf_dir):
    kind = F.col("event_type")
    line = (
        F.when(kind == "view", F.lit(""))
        .when(kind == "signup", F.concat(F.lit("a\t"), F.col("user_id")))
        .when(kind == "purchase", F.concat(F.lit("x\t7\t["), F.col("user_id"), F.lit("] tail")))
        .otherwise(event_line())
    )
    return lines_of(table(spark, sf_dir, "events", "event_id"), "events", "event_id", line)


@query(
    _REASONS
    + """
SELECT reject_reason, count(*) AS lines FROM reason
WHERE reject_reason IS NOT NULL GROUP BY reject_reason
"""
)
def reject_reasons(spark, sf_dir):
    rejected = parse.rejects(parse.json_records(_defective_lines(spark, sf_dir)))
    return rejected.groupBy("reject_reason").agg(F.count(F.lit(1)).alias("lines"))


@query(
    _REASONS
    + """
SELECT 'events' AS source_file, count(*) AS total, count(*) FILTER (reject_reason IS NULL) AS written,
       count(reject_reason) AS skipped, count(*) FILTER (reject_reason = 'bad_json') AS bad_json
FROM reason
"""
)
def ingest_metrics(spark, sf_dir):
    return parse.ingest_metrics(parse.json_records(_defective_lines(spark, sf_dir)), "source_file")


_COVER_LINE = """
WITH line AS (
  SELECT o_orderkey, concat_ws(chr(9), o_orderkey::VARCHAR, o_custkey::VARCHAR,
         CASE o_orderstatus WHEN 'F' THEN 'x' ELSE (o_custkey + 1)::VARCHAR END,
         CASE o_orderstatus WHEN 'P' THEN NULL ELSE strftime(o_orderdate, '%Y-%m-%d') END) AS line
  FROM orders
), split AS (SELECT *, string_split(line, chr(9)) AS f FROM line)
"""


def cover_lines(spark, sf_dir):
    line = F.concat_ws(
        "\t",
        F.col("o_orderkey").cast("string"),
        F.col("o_custkey").cast("string"),
        F.when(F.col("o_orderstatus") == "F", F.lit("x")).otherwise(
            (F.col("o_custkey") + 1).cast("string")
        ),
        F.when(F.col("o_orderstatus") != "P", F.date_format("o_orderdate", "yyyy-MM-dd")),
    )
    return lines_of(table(spark, sf_dir, "orders"), "orders", "o_orderkey", line)


@query(
    _COVER_LINE
    + """
SELECT TRY_CAST(f[1] AS BIGINT) AS cover_id, TRY_CAST(f[2] AS INTEGER) AS width,
       TRY_CAST(f[3] AS INTEGER) AS height, TRY_CAST(f[4] AS DATE) AS created
FROM split WHERE len(f) = 4
"""
)
def covers_tsv(spark, sf_dir):
    parsed = parse.accepted(parse.covers(cover_lines(spark, sf_dir)))
    return parsed.select("cover_id", "width", "height", "created")


@query(
    _COVER_LINE
    + """
SELECT TRY_CAST(f[1] AS BIGINT) AS cover_id, TRY_CAST(f[2] AS INTEGER) AS width,
       TRY_CAST(f[3] AS INTEGER) AS height
FROM split WHERE len(f) = 4 AND TRY_CAST(f[1] AS BIGINT) > 0
"""
)
def covers_from_lines(spark, sf_dir):
    """Cover lines to the cover catalog; covers numbered 0 are dropped."""
    parsed = parse.accepted(parse.covers(cover_lines(spark, sf_dir)))
    return covers.build_covers(parsed).select("cover_id", "width", "height")


@query(
    """
SELECT c_custkey AS source_offset, c_custkey::VARCHAR AS c1, c_name || ' "the ' || c_mktsegment || '"' AS c2,
       CASE WHEN c_mktsegment = 'BUILDING' THEN NULL ELSE c_mktsegment END AS c3, '' AS c4
FROM customer WHERE c_mktsegment <> 'MACHINERY'
"""
)
def generic_tsv(spark, sf_dir):
    """Quoted fields, doubled quotes, empty fields, the NULL marker, rows too long."""
    segment = F.col("c_mktsegment")
    line = F.concat(
        F.col("c_custkey"),
        F.lit('\t"'), F.col("c_name"), F.lit(' ""the '), segment, F.lit('"""\t'),
        F.when(segment == "BUILDING", F.lit("\\N")).otherwise(segment),
        F.lit("\t"),
        F.when(segment == "MACHINERY", F.lit("\tmore")).otherwise(F.lit("")),
    )
    lines = lines_of(table(spark, sf_dir, "customer"), "customer", "c_custkey", line)
    parsed = parse.accepted(parse.generic_tsv(lines, 4))
    return parsed.select("source_offset", "c1", "c2", "c3", "c4")


def _wikidata_lines(spark, sf_dir):
    kind = F.col("event_type")
    quoted = F.concat(F.lit('"'), F.replace(F.col("props"), F.lit('"'), F.lit('""')), F.lit('"'))
    with_id = F.concat(
        F.lit('"{""id"":""P'), F.col("user_id"), F.lit('"",""n"":'), F.col("event_id"), F.lit('}"')
    )
    line = F.concat(
        F.lit("Q"),
        F.col("event_id"),
        F.when(kind == "signup", F.lit("")).otherwise(F.lit("\t")),
        F.when(kind == "click", quoted)
        .when(kind == "view", with_id)
        .when(kind == "error", F.lit("{bad"))
        .when(kind == "purchase", F.lit("text"))
        .otherwise(F.lit("")),
    )
    return lines_of(table(spark, sf_dir, "events", "event_id"), "events", "event_id", line)


@query(
    """
SELECT event_id AS source_offset,
       CASE event_type WHEN 'view' THEN 'P' || user_id ELSE 'Q' || event_id END AS wd_id,
       CAST(json(CASE event_type WHEN 'view' THEN '{"id":"P' || user_id || '","n":' || event_id || '}'
            ELSE props END) AS VARCHAR) AS canonical
FROM events WHERE event_type IN ('click', 'view')
"""
)
def wikidata_tsv(spark, sf_dir):
    parsed = parse.accepted(parse.wikidata(_wikidata_lines(spark, sf_dir)))
    return parsed.select(
        "source_offset", "wd_id", json.compact(F.col("data")).alias("canonical")
    )


@query(
    """
SELECT CASE event_type WHEN 'signup' THEN 'field_count' WHEN 'error' THEN 'bad_json'
       ELSE 'no_json' END AS reject_reason, count(*) AS lines
FROM events WHERE event_type IN ('signup', 'error', 'purchase') GROUP BY 1
"""
)
def wikidata_rejects(spark, sf_dir):
    rejected = parse.rejects(parse.wikidata(_wikidata_lines(spark, sf_dir)))
    return rejected.groupBy("reject_reason").agg(F.count(F.lit(1)).alias("lines"))


@query(
    """
SELECT event_id AS source_offset,
       CASE WHEN event_type <> 'signup' THEN 'Q' || event_id END AS wd_id,
       CAST(json(props) AS VARCHAR) AS canonical
FROM events
"""
)
def wikidata_lenient(spark, sf_dir):
    """JSON anywhere in the line, quoted or not, with or without an id."""
    kind, props = F.col("event_type"), F.col("props")
    key = F.concat(F.lit("Q"), F.col("event_id"))
    doubled = F.replace(props, F.lit('"'), F.lit('""'))
    line = (
        F.when(kind == "signup", F.concat(F.lit("no tab "), props))
        .when(kind == "click", F.concat(key, F.lit('\t"'), doubled, F.lit('"')))
        .when(kind == "view", F.concat(key, F.lit("\tsome text "), props))
        .otherwise(F.concat(key, F.lit("\t"), props))
    )
    lines = lines_of(table(spark, sf_dir, "events", "event_id"), "events", "event_id", line)
    parsed = parse.accepted(parse.wikidata(lines, lenient=True))
    return parsed.select(
        "source_offset", "wd_id", json.compact(F.col("data")).alias("canonical")
    )


@query(
    r"""
SELECT doc_id,
       replace(replace(replace(replace(text, '\', '\\'), chr(9), '\t'), chr(10), '\n'), chr(13), '\r') AS escaped,
       translate(text, chr(9) || chr(10) || chr(13), '   ') AS flat
FROM documents
"""
)
def escaped_text(spark, sf_dir):
    """Whole texts as fields of a TSV sink."""
    return table(spark, sf_dir, "documents", "doc_id").select(
        "doc_id",
        tsv.escape_text(F.col("text")).alias("escaped"),
        tsv.escape_json(F.col("text")).alias("flat"),
    )


@query(
    r"""
SELECT o_orderkey FROM orders WHERE o_orderkey > (SELECT coalesce(max(c_custkey), 0) FROM customer)
"""
)
def read_after_mark(spark, sf_dir):
    """Orders beyond the highest customer number."""
    mark = high_water_mark(table(spark, sf_dir, "customer"), "c_custkey").first()[0]
    return after_mark(table(spark, sf_dir, "orders"), "o_orderkey", mark, ["o_orderkey"])


@query(
    r"""
SELECT doc_id, length(text) AS characters,
       length(regexp_replace(regexp_replace(text, '^\s+', ''), '\s+$', '')) AS stripped
FROM documents
"""
)
def stripped_text(spark, sf_dir):
    return table(spark, sf_dir, "documents", "doc_id").select(
        "doc_id",
        F.char_length("text").cast("bigint").alias("characters"),
        F.char_length(strip(F.col("text"))).cast("bigint").alias("stripped"),
    )
