"""Dump lines to records.

Each reader takes a DataFrame with a ``line`` column and returns every input row with the
parsed columns and ``reject_reason``, NULL for accepted rows.  Other input columns
(file, position) pass through.  The readers are plain projections, so they serve batch
and streaming input alike and need no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stackroom.functions import json, records, tsv
from stackroom.functions.text import strip

EMPTY_LINE = "empty_line"
NO_JSON = "no_json"
BAD_JSON = "bad_json"
FIELD_COUNT = "field_count"
BLANK_JSON = "blank_json"


def accepted(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("reject_reason").isNull()).drop("reject_reason")


def rejects(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("reject_reason").isNotNull())


def _passing(lines: DataFrame) -> list[Column]:
    return [F.col(c) for c in lines.columns if c != "line"]


def json_records(lines: DataFrame) -> DataFrame:
    """ol_key, revision, last_modified, data_json (as read) and data (VARIANT)."""
    line = F.col("line")
    located = lines.select(
        *_passing(lines),
        json.json_start(line).alias("data_json"),
        records.stripped_fields(line).alias("fields"),
        (line == "").alias("is_empty"),
    )
    # What follows the JSON does no harm to the parser; data_json goes without it.
    located = json.parse_once(located, "data_json", "data").withColumn(
        "data_json", strip(F.col("data_json"))
    )
    data, fields = F.col("data"), F.col("fields")
    return located.select(
        *_passing(lines),
        records.record_key(data).alias("ol_key"),
        records.revision(fields).alias("revision"),
        records.last_modified(fields).alias("last_modified"),
        json.value_text(F.col("data_json"), data).alias("data_json"),
        "data",
        F.when(F.col("is_empty"), EMPTY_LINE)
        .when(F.col("data_json").isNull(), NO_JSON)
        .when(data.isNull(), BAD_JSON)
        .alias("reject_reason"),
    )


def covers(lines: DataFrame) -> DataFrame:
    """cover_id, width, height, created of lines with exactly four fields."""
    split = lines.select(
        *_passing(lines),
        tsv.plain_fields(F.col("line")).alias("fields"),
        (F.col("line") == "").alias("is_empty"),
    )
    fields = F.col("fields")

    def field(place: int, kind: str) -> Column:
        return strip(F.get(fields, F.lit(place))).try_cast(kind)

    return split.select(
        *_passing(lines),
        field(0, "bigint").alias("cover_id"),
        field(1, "int").alias("width"),
        field(2, "int").alias("height"),
        field(3, "date").alias("created"),
        F.when(F.col("is_empty"), EMPTY_LINE)
        .when(F.size(fields) != 4, FIELD_COUNT)
        .alias("reject_reason"),
    )


def generic_tsv(lines: DataFrame, columns: int) -> DataFrame:
    """Text columns c1..cN of lines with exactly ``columns`` fields."""
    split = lines.select(*_passing(lines), tsv.quoted_fields(F.col("line")).alias("fields"))
    fields = F.col("fields")
    return split.select(
        *_passing(lines),
        *[
            tsv.marker_to_null(tsv.flatten_breaks(F.get(fields, F.lit(i)))).alias(f"c{i + 1}")
            for i in range(columns)
        ],
        F.when(F.size(fields) == 0, EMPTY_LINE)
        .when(fields.isNull() | (F.size(fields) != columns), FIELD_COUNT)
        .alias("reject_reason"),
    )


def wikidata(lines: DataFrame, lenient: bool = False) -> DataFrame:
    """wd_id, data_json and data (VARIANT) of an id and a quoted JSON field.

    ``lenient`` finds the JSON anywhere in the line instead of in the second field.
    """
    line = F.col("line")
    if lenient:
        split = _lenient_wikidata(lines)
        enough = F.lit(True)
    else:
        fields = tsv.quoted_fields(line)
        split = lines.select(*_passing(lines), fields.alias("fields")).select(
            *_passing(lines),
            "fields",
            F.nullif(F.get("fields", F.lit(0)), F.lit("")).alias("first"),
            F.get("fields", F.lit(1)).alias("second"),
        ).withColumn("data_json", strip(F.col("second")))
        enough = F.col("fields").isNotNull() & (F.size("fields") >= 2)
    decoded = split.select(
        *_passing(lines),
        strip(F.col("first")).alias("line_id"),
        "data_json",
        F.when(F.col("data_json").rlike(r"^[{\[]"), F.col("data_json")).alias("json_text"),
        enough.alias("enough"),
    )
    decoded = json.parse_once(decoded, "json_text", "data")
    own_id = F.nullif(json.text_at(F.col("data"), "id"), F.lit(""))
    return decoded.select(
        *_passing(lines),
        F.coalesce(own_id, F.col("line_id")).alias("wd_id"),
        json.value_text(F.col("data_json"), F.col("data")).alias("data_json"),
        "data",
        F.when(~F.col("enough"), FIELD_COUNT)
        .when(F.coalesce(F.col("data_json"), F.lit("")) == "", BLANK_JSON)
        .when(~F.col("data_json").rlike(r"^[{\[]"), NO_JSON)
        .when(F.col("data").isNull(), BAD_JSON)
        .alias("reject_reason"),
    )


def _lenient_wikidata(lines: DataFrame) -> DataFrame:
    """The id before the first tab, and the JSON wherever it starts."""
    line, parts = F.col("line"), F.split("line", "\t", 2)
    # Without a tab the line has no id and is searched from its first bracket.
    has_tab = F.contains(line, F.lit("\t"))
    blob = lines.select(
        *_passing(lines),
        F.when(has_tab, F.nullif(strip(F.get(parts, F.lit(0))), F.lit(""))).alias("first"),
        strip(F.when(has_tab, F.get(parts, F.lit(1))).otherwise(json.json_start(line))).alias("blob"),
    )
    text = F.col("blob")
    quoted = text.rlike(r'(?s)^".*"\z')
    inner = F.replace(F.substr(text, F.lit(2), F.char_length(text) - 2), F.lit('""'), F.lit('"'))
    unquoted = blob.select(
        *_passing(lines), "first", F.when(quoted, inner).otherwise(text).alias("text")
    )
    return unquoted.select(
        *_passing(lines),
        "first",
        F.coalesce(json.json_start(F.col("text")), F.col("text")).alias("data_json"),
    )


def ingest_metrics(parsed: DataFrame, *by: str) -> DataFrame:
    """Lines read, written, skipped, and skipped for undecodable JSON, per ``by``."""
    reason = F.col("reject_reason")
    return parsed.groupBy(*by).agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(reason.isNull()).alias("written"),
        F.count_if(reason.isNotNull()).alias("skipped"),
        F.count_if(reason == BAD_JSON).alias("bad_json"),
    )
