"""Fields of dump lines and of decoded records."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stackroom import fixed_values as fixed
from stackroom.functions import json
from stackroom.functions.dates import iso_datetime
from stackroom.functions.text import casefold, strip


# --- dump lines ---------------------------------------------------------------------


def stripped_fields(line: Column) -> Column:
    return F.transform(F.split(line, "\t", -1), strip)


def record_key(value: Column) -> Column:
    """Top-level ``key`` if it is non-empty text.  It is kept whole: rows are told apart by it."""
    return F.nullif(json.text_at(value, "key"), F.lit(""))


def revision(fields: Column) -> Column:
    """First field that is all digits."""
    # The comparison looks at the first byte, so that JSON is not searched for digits.
    digits = F.filter(fields, lambda f: (f >= "0") & (f < ":") & f.rlike(r"^[0-9]+\z"))
    return F.try_element_at(digits, F.lit(1)).try_cast("int")


def last_modified(fields: Column) -> Column:
    """Last field that is neither empty nor long."""
    short = F.filter(
        fields,
        lambda f: (f != "")
        # A character has four bytes at most; counting bytes is free.
        & (F.octet_length(f) <= 4 * fixed.MAX_LAST_MODIFIED)
        & (F.char_length(f) <= fixed.MAX_LAST_MODIFIED),
    )
    return F.try_element_at(short, F.lit(-1))


# --- decoded records -----------------------------------------------------------------

#: What a record holds under a name: a look-up in a VARIANT, or ``member`` of a structure made by one pass over it.
Field = Callable[[Column, str], Column]


def member(record: Column, name: str) -> Column:
    return record[name]


def record_type(value: Column) -> Column:
    return json.text_at(value, "type", "key")


def record_datetime(value: Column, name: str) -> Column:
    """Time under ``{"value": ISO text}``; plain text does not count."""
    return iso_datetime(json.text_at(value, name, "value"))


def _texts(listed: Column) -> Column:
    """Non-blank text items of a list, stripped, in order; empty when there is no list."""
    # One step per lambda: inside a lambda Spark evaluates a repeated part every time.
    texts = F.transform(json.list_texts(listed), strip)
    return F.coalesce(F.filter(texts, lambda t: t != ""), F.array().cast("array<string>"))


def all_subjects(value: Column, field: Field = json.field) -> Column:
    return F.concat(*[_texts(field(value, name)) for name in fixed.SUBJECT_KEYS])


def first_spellings(texts: Column, folded: Column) -> Column:
    """``texts`` without items whose ``folded`` form came before."""
    distinct = F.array_distinct(folded)
    firsts = F.transform(
        distinct, lambda f: F.element_at(texts, F.array_position(folded, f).cast("int"))
    )
    return F.when(F.size(distinct) == F.size(texts), texts).otherwise(firsts)


def folded_items(texts: Column) -> Column:
    return F.transform(texts, casefold)


def with_subjects(df: DataFrame, data: str, out: str) -> DataFrame:
    """``df`` with the subjects of a VARIANT column, each spelling once."""
    # Two steps, so that texts and their folded forms are computed once per row.
    texts = df.withColumn("_texts", all_subjects(F.col(data)))
    folded = texts.withColumn("_folded", folded_items(F.col("_texts")))
    distinct = folded.withColumn(out, first_spellings(F.col("_texts"), F.col("_folded")))
    return distinct.drop("_texts", "_folded")


def cover_ids(value: Column, name: str, field: Field = json.field) -> Column:
    """Distinct cover numbers of a list, in order; empty when there is no list."""
    listed = field(value, name)
    digits = F.filter(F.transform(json.list_items(listed), json.as_digits), lambda d: d != "")
    # Numbers beyond BIGINT become NULL.
    numbers = F.transform(digits, lambda d: d.try_cast("bigint"))
    # A list of nothing but numbers and nulls is taken as a whole.
    whole = F.schema_of_variant(listed) == "ARRAY<BIGINT>"
    numbers = F.when(whole, F.try_variant_get(listed, "$", "array<bigint>")).otherwise(numbers)
    return F.coalesce(F.array_distinct(F.array_compact(numbers)), F.array().cast("array<bigint>"))


def split_sources(texts: Column) -> Column:
    """``source:key`` at the first colon; without a source it is ``unknown``.

    ``texts`` are stripped; pairs without a key are dropped.
    """
    parts = F.transform(texts, lambda t: F.split(t, ":", 2))
    whole = F.transform(
        parts, lambda p: F.when(F.size(p) == 1, F.array(F.lit(""), p[0])).otherwise(p)
    )
    clean = F.transform(whole, lambda p: F.transform(p, strip))
    pairs = F.transform(
        clean,
        lambda p: F.struct(
            F.when(p[0] == "", fixed.UNKNOWN_SOURCE)
            .otherwise(p[0])
            .alias("source"),
            p[1].alias("source_key"),
        ),
    )
    return F.filter(pairs, lambda s: s["source_key"] != "")


def source_records(value: Column, field: Field = json.field) -> Column:
    """(source, source_key) pairs of a record."""
    return split_sources(_texts(field(value, "source_records")))


def array_text(items: Column) -> Column:
    """JSON text of an array, NULL when it is empty."""
    return F.when(F.size(items) > 0, F.to_json(items))


def cut_to_limits(rows: DataFrame) -> DataFrame:
    """``rows`` with texts cut to the lengths a target's columns take.

    For output alone: what is cut no longer tells rows apart.
    """
    limits = {c: n for c, n in fixed.TEXT_LIMITS.items() if c in rows.columns}
    return rows.withColumns({c: F.left(F.col(c), F.lit(n)) for c, n in limits.items()})
