"""JSON expressions over VARIANT values.

A key may hold text in one record and an object in the next, so documents are never
forced into one schema.  ``try_variant_get(..., 'string')`` alone would turn numbers and
objects into text; the guards below look at the stored type first.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stackroom.functions.once import compute_once
from stackroom.functions.text import blank_to_null


def json_start(line: Column) -> Column:
    """Text from the first ``{`` or ``[`` on; NULL without one."""
    first = F.least(
        F.nullif(F.instr(line, "{"), F.lit(0)), F.nullif(F.instr(line, "["), F.lit(0))
    )
    return F.substr(line, first)


def parse(text: Column) -> Column:
    """First JSON value in ``text`` as VARIANT, NULL when it is not JSON."""
    return F.try_parse_json(text)


def parse_once(df: DataFrame, text: str, out: str) -> DataFrame:
    """``df`` with ``out``, the parsed form of column ``text``, parsed once per row."""
    return compute_once(df, out, parse(F.col(text)))


def value_text(text: Column, value: Column) -> Column:
    """``text`` without what follows its first JSON value, whose parsed form is ``value``.

    The text of a value ends with its closing bracket.  Where something else may follow, the text up to
    the last such bracket is taken if it is one value and nothing more, else the value's canonical text.
    (A second value right behind a comma, closed by the same bracket, stays.)
    """
    closing = F.when(F.startswith(text, F.lit("{")), "}").otherwise("]")
    more = ~F.endswith(text, closing) | text.rlike(r"[}\]]\s*[^\s,}\]]")
    cut = F.substr(text, F.lit(1), F.length(text) + 1 - F.instr(F.reverse(text), closing))
    # With a zero behind it, one value makes a list of two: brackets of its own would have closed it before.
    held = F.try_parse_json(F.concat(F.lit("["), cut, F.lit(",0]")))
    alone = F.size(F.try_variant_get(held, "$", "array<variant>")) == 2
    return F.when(value.isNull() | ~more, text).when(alone, cut).otherwise(F.to_json(value))


def compact(value: Column) -> Column:
    """Canonical JSON text: no spaces, sorted keys, non-ASCII kept."""
    return F.to_json(value)


def _path(*names: str) -> str:
    return "$." + ".".join(names)


def field(value: Column, *names: str) -> Column:
    return F.try_variant_get(value, _path(*names), "variant")


def as_text(value: Column) -> Column:
    """Text if the value is text, else NULL."""
    return F.when(F.schema_of_variant(value) == "STRING", F.try_variant_get(value, "$", "string"))


def text_at(value: Column, *names: str) -> Column:
    """Text under a key if it is text, else NULL."""
    return F.when(
        F.schema_of_variant(field(value, *names)) == "STRING",
        F.try_variant_get(value, _path(*names), "string"),
    )


def as_digits(value: Column) -> Column:
    """Integers, and text made of digits, as text; else NULL."""
    text = F.try_variant_get(value, "$", "string")
    kind = F.schema_of_variant(value)
    return F.when(kind == "BIGINT", text).when(
        kind == "STRING", F.regexp_extract(text, r"^[0-9]+\z", 0)
    )


def raw_text(value: Column, name: str) -> Column:
    """Text under a key, or under its ``value`` when it holds an object."""
    return F.coalesce(text_at(value, name), text_at(value, name, "value"))


def own_text(value: Column) -> Column:
    """``raw_text`` of what is under the key."""
    return F.coalesce(as_text(value), text_at(value, "value"))


def text_or_value(value: Column, name: str) -> Column:
    """``raw_text`` stripped; NULL when blank."""
    return blank_to_null(raw_text(value, name))


def members(value: Column, names: Sequence[str]) -> Column:
    """Structure of what an object holds under ``names``, as VARIANT; NULL where it lacks one.

    One pass over an object costs as much as a few look-ups by path.
    """
    return F.try_variant_get(value, "$", "struct<" + ", ".join(f"`{n}`: variant" for n in names) + ">")


def list_items(listed: Column) -> Column:
    """Items of a list; NULL when it is none."""
    return F.try_variant_get(listed, "$", "array<variant>")


def list_texts(listed: Column) -> Column:
    """Items of a list, NULL for those that are not text; NULL when it is no list.

    A list of nothing but texts and nulls, told by its type, is taken as a whole.
    """
    whole = F.schema_of_variant(listed) == "ARRAY<STRING>"
    return F.when(whole, F.try_variant_get(listed, "$", "array<string>")).otherwise(
        F.transform(list_items(listed), as_text)
    )


def is_blank(text: Column) -> Column:
    """True when JSON text holds an empty object or list: nothing to import."""
    return text.rlike(r"^(?:\{\s*\}|\[\s*\])")
