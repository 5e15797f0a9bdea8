"""Date expressions over dirty text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from stackroom.functions.text import strip

_FULL_DATE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}\z"
# A year from 1000 to 2199 that stands as a word of its own.  Explicit look-arounds:
# whether \b knows Unicode depends on the Java version.
_YEAR = r"(?<![\p{L}\p{N}_])(1[0-9]{3}|2[01][0-9]{2})(?![\p{L}\p{N}_])"

_ZONE = r"(?:Z|[+-](?:[01][0-9]|2[0-3])(?::?[0-5][0-9]){0,2})?"
_ISO = (
    r"^([0-9]{4}-[0-9]{2}-[0-9]{2}(?:.[0-9]{2}(?::[0-9]{2}(?::[0-9]{2})?)?)?)(?:,[0-9]+)?"
    + _ZONE
    + r"\z"
)
#: The usual spelling, which the steps below would leave as it is.
_PLAIN = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}\z"
_BASIC_DAY = "^([0-9]{4})([0-9]{2})([0-9]{2})"
_BASIC_CLOCK = "^(.{11}[0-9]{2})([0-9]{2})([0-9]{2})?"


def year_or_date(text: Column) -> Column:
    """``YYYY-MM-DD`` as it is, else the first year as ``YYYY-01-01``, else NULL."""
    clean = strip(text)
    year = F.nullif(F.regexp_extract(clean, _YEAR, 1), F.lit(""))
    return F.when(clean.rlike(_FULL_DATE), clean).otherwise(
        F.concat(year, F.lit("-01-01"))
    )


def iso_datetime(text: Column) -> Column:
    """Wall-clock time of ISO text to the second; fraction and zone are dropped.

    Whatever follows the first ``.`` cannot change the result: it is either a
    fraction with an optional zone, or it is ignored on the second attempt.
    """
    base = F.substring_index(strip(text), ".", 1)
    # 20211226T213202 gets the separators of the usual spelling.
    spaced = F.regexp_replace(
        F.regexp_replace(base, _BASIC_DAY, "$1-$2-$3"), _BASIC_CLOCK, "$1:$2:$3"
    )
    wall = F.regexp_extract(F.rtrim(spaced, F.lit(":")), _ISO, 1)
    # Any one character may stand between day and time; the cast knows two.
    other = F.regexp_replace(wall, "^(.{10})[^T ]", "$1 ").try_cast("timestamp_ntz")
    return F.when(text.rlike(_PLAIN), text.try_cast("timestamp_ntz")).otherwise(other)


def updated_or_created(updated: Column, created: Column, as_of: Column | None = None) -> Column:
    """Last change, else creation, else ``as_of`` when one is given."""
    return F.coalesce(updated, created, *([as_of] if as_of is not None else []))
