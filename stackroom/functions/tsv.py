"""Tab-separated text: reading quoted fields, writing escaped ones."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from stackroom.fixed_values import NULL_MARKER

# One field: quoted (a doubled quote stands for one; whatever follows the closing quote
# up to the next tab still belongs to the field), or bare.  Possessive quantifiers keep the
# matcher iterative, so fields of many megabytes do not exhaust the stack.
_QUOTED_BODY = r'"([^"]*+(?:""[^"]*+)*+)'
_FIELD = r'\t("[^"]*+(?:""[^"]*+)*+(?:"[^\t]*+)?|[^\t"][^\t]*+|)'


def plain_fields(line: Column) -> Column:
    return F.split(line, "\t", -1)


def _unquote(raw: Column) -> Column:
    body = F.regexp_extract(raw, "^" + _QUOTED_BODY, 1)
    tail = F.substr(raw, F.char_length(body) + 3)
    return F.when(
        F.startswith(raw, F.lit('"')),
        F.concat(F.replace(body, F.lit('""'), F.lit('"')), tail),
    ).otherwise(raw)


def _outside_quotes(raw: Column) -> Column:
    """The part of a field that no quotes protect."""
    return F.regexp_replace(raw, "^" + _QUOTED_BODY + '"?', "")


def quoted_fields(line: Column) -> Column:
    """Fields of one line; an empty array for a blank line, NULL for a broken one.

    A carriage return outside quotes ends the line: nothing may follow it.
    """
    raw = F.regexp_extract_all(F.concat(F.lit("\t"), line), F.lit(_FIELD), 1)
    bare_line = F.rtrim(line, F.lit("\r"))
    has_quote = F.contains(line, F.lit('"'))
    has_return = F.contains(line, F.lit("\r"))

    last = F.element_at(raw, -1)
    early = F.slice(raw, 1, F.size(raw) - 1)
    broken = F.exists(early, lambda f: F.contains(_outside_quotes(f), F.lit("\r"))) | (
        _outside_quotes(last).rlike("\r[^\r]")
    )
    open_end = F.regexp_extract(last, "^" + _QUOTED_BODY, 0) == last
    cut_last = F.when((last != "") & open_end, last).otherwise(F.rtrim(last, F.lit("\r")))
    with_return = F.when(
        ~broken, F.transform(F.concat(early, F.array(cut_last)), _unquote)
    )

    return (
        F.when(bare_line == "", F.array().cast("array<string>"))
        .when(~has_quote & ~has_return, plain_fields(line))
        .when(~has_quote & ~F.contains(bare_line, F.lit("\r")), plain_fields(bare_line))
        .when(~has_return, F.transform(raw, _unquote))
        .otherwise(with_return)
    )


def flatten_breaks(text: Column) -> Column:
    """Tabs and line breaks inside a field become spaces."""
    return F.translate(text, "\t\n\r", "   ")


def marker_to_null(text: Column) -> Column:
    return F.nullif(text, F.lit(NULL_MARKER))


def escape_text(text: Column) -> Column:
    """A short text field for a TSV sink; NULL becomes the marker."""
    escaped = text
    for char, code in (("\\", "\\\\"), ("\t", "\\t"), ("\n", "\\n"), ("\r", "\\r")):
        escaped = F.replace(escaped, F.lit(char), F.lit(code))
    return F.coalesce(escaped, F.lit(NULL_MARKER))


def escape_json(text: Column) -> Column:
    """A JSON field for a TSV sink: breaks to spaces, backslashes left alone."""
    return F.coalesce(flatten_breaks(text), F.lit(NULL_MARKER))
