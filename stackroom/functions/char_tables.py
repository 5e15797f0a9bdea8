"""Per-character text mappings as built-in Spark expressions.

A mapping such as "strip accents" works on one character at a time, so it can be
tabulated once on the driver by a rule over Unicode and applied on the JVM with
``translate`` (one character to one or none) plus a short expansion step for the few
characters that become several.  No Python runs on the executors.
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Callable
from dataclasses import dataclass
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from stackroom.fixed_values import CYRILLIC_TO_LATIN


@dataclass(frozen=True)
class CharTable:
    source: str  # characters replaced one by one ...
    target: str  # ... by these; source characters beyond its length are removed
    wide: str  # characters that become several ...
    expansions: str  # ... and what they become, separated by spaces

    def wide_ranges(self) -> str:
        """A short character class around ``wide``: a list of hundreds is slow to match."""
        ranges: list[list[int]] = []
        for code in sorted(map(ord, self.wide)):
            if ranges and code - ranges[-1][1] <= 16:
                ranges[-1][1] = code
            else:
                ranges.append([code, code])
        return "[" + "".join(f"{chr(first)}-{chr(last)}" for first, last in ranges) + "]"


def _all_characters():
    for code in range(sys.maxunicode + 1):
        char = chr(code)
        # Unassigned, private and surrogate code points have no mapping.
        if unicodedata.category(char) not in ("Cn", "Co", "Cs"):
            yield char


def _tabulate(rule: Callable[[str], str], candidates) -> CharTable:
    single, removed, wide = [], [], []
    for char in candidates:
        mapped = rule(char)
        if mapped == char:
            continue
        if len(mapped) == 1:
            single.append((char, mapped))
        elif mapped:
            wide.append((char, mapped))
        else:
            removed.append(char)
    return CharTable(
        source="".join(c for c, _ in single) + "".join(removed),
        target="".join(m for _, m in single),
        wide="".join(c for c, _ in wide),
        expansions=" ".join(m for _, m in wide),
    )


def _decompose(text: str) -> str:
    return unicodedata.normalize("NFKD", text)


def fold_character(char: str) -> str:
    """Lower-case Latin form of one character, without marks; '-' for what has none."""
    spelled = "".join(CYRILLIC_TO_LATIN.get(c, c) for c in _decompose(char).lower())
    bare = "".join(c for c in _decompose(spelled) if unicodedata.category(c) != "Mn").lower()
    # Slugs keep only these characters, so every other run can be a hyphen already.
    slug = "".join(c if c in "abcdefghijklmnopqrstuvwxyz0123456789" else "-" for c in bare)
    while "--" in slug:
        slug = slug.replace("--", "-")
    return slug


@lru_cache(maxsize=None)
def fold_table() -> CharTable:
    def keeps_something(char: str) -> bool:
        return (
            unicodedata.category(char) == "Mn"
            or char.lower() in CYRILLIC_TO_LATIN
            or char.lower() != char
            or unicodedata.decomposition(char) != ""
        )

    def rule(char: str) -> str:
        folded = fold_character(char)
        # A lone hyphen is what the slug pattern makes of the character anyway.
        return char if folded == "-" else folded

    return _tabulate(rule, filter(keeps_something, _all_characters()))


@lru_cache(maxsize=None)
def casefold_table() -> CharTable:
    return _tabulate(str.casefold, _all_characters())


@lru_cache(maxsize=None)
def whitespace() -> str:
    """Every character that counts as white space when text is stripped."""
    return "".join(c for c in map(chr, range(sys.maxunicode + 1)) if c.isspace())


def is_ascii(text: Column) -> Column:
    return F.octet_length(text) == F.char_length(text)


def apply_table(text: Column, table: CharTable) -> Column:
    """``text`` with ``table`` applied; ASCII text takes the cheap way (``lower``)."""
    mapped = F.translate(text, table.source, table.target)
    expansions = F.split(F.lit(table.expansions), " ")

    def expand(char: Column) -> Column:
        place = F.instr(F.lit(table.wide), char)
        return F.when(F.octet_length(char) == 1, char).otherwise(
            F.when(place > 0, F.element_at(expansions, place)).otherwise(char)
        )

    expanded = F.when(
        mapped.rlike(table.wide_ranges()),
        F.array_join(F.transform(F.split(mapped, ""), expand), ""),
    ).otherwise(mapped)
    return F.when(is_ascii(text), F.lower(text)).otherwise(expanded)
