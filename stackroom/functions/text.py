"""Text expressions: strip, slugs, names, limits."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from stackroom import fixed_values as fixed
from stackroom.functions.char_tables import apply_table, casefold_table, fold_table, whitespace


def strip(text: Column) -> Column:
    """Unicode white space off both ends (``trim`` alone knows only U+0020).

    Trimming a set of characters walks the whole text.  Text that begins and ends with a
    printable ASCII character, told by its first and last byte, needs none.
    """
    last = F.substring(text.cast("binary"), -1, 1)
    clean = (text >= "!") & (text < "\x7f") & last.between(F.lit(b"!"), F.lit(b"~"))
    return F.when(clean, text).otherwise(F.btrim(text, F.lit(whitespace())))


def blank_to_null(text: Column) -> Column:
    """Stripped text, NULL when nothing is left."""
    return F.nullif(strip(text), F.lit(""))


def casefold(text: Column) -> Column:
    """Full Unicode case folding, the key under which spellings count as equal."""
    return apply_table(text, casefold_table())


def slugify(text: Column) -> Column:
    """Lower-case Latin words joined by hyphens; NULL when no letter or digit is left."""
    folded = apply_table(text, fold_table())
    hyphened = F.regexp_replace(folded, "[^a-z0-9]+", "-")
    return F.nullif(F.btrim(hyphened, F.lit("-")), F.lit(""))


def entity_slug(title: Column, number: Column) -> Column:
    """Slug of the title, or the number as text, cut to size, plus the number."""
    number_text = number.cast("string")
    base = F.coalesce(slugify(title), number_text)
    cut = F.rtrim(F.left(base, F.lit(fixed.MAX_SLUG_BASE)), F.lit("-"))
    # left() returns shorter text unchanged and slugs never end in a hyphen.
    return F.concat_ws("-", cut, number_text)


def intro(content: Column) -> Column:
    return F.left(content, F.lit(fixed.INTRO_LENGTH))


def author_name(personal: Column, last: Column, name: Column) -> Column:
    """Display name; the last name is added unless the personal name holds it.

    The parts are stripped, and NULL instead of blank.
    """
    extra = F.when(
        personal.isNull() | ~F.contains(F.lower(personal), F.lower(last)),
        last,
    )
    return F.coalesce(F.nullif(F.concat_ws(" ", personal, extra), F.lit("")), name)


def numeric_key(key: Column) -> Column:
    """The number in a record key such as ``/works/OL12W``; NULL without one."""
    return F.regexp_extract(strip(key), fixed.NUMERIC_KEY_PATTERN, 1).try_cast("bigint")
