"""Language identification by cross-parsing entropy.

A suffix automaton of labelled text of each language knows all its substrings.  A text is parsed
greedily into the longest phrases that a language's automaton knows; a language's rate is
the number of phrases, times the bits that name a phrase's place in the learned text, for each letter
of the text.  The language with the lowest rate wins (of equal ones the first by name).

Automata are run for many texts at a time: a table gives the next state for each state and
symbol, with phrases' ends marked, so a step of all texts is one look-up.  Long texts are parsed
whole, in stretches of ``STRETCH`` symbols that each begin a phrase.

Learning takes a bounded sample: of each language the ``SAMPLE`` labelled documents of the smallest hashes
of their keys, and of each of them ``EXCERPT`` characters from a place given by that hash.

Defined results: a text that is null or has no letter is ``und`` with score 0, and so is any text if
nothing was learned; the score is 1 - lowest rate / second rate (1 with one language); rows with a null key
are predicted but not learned from; repeated rows get equal results; other columns are kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Documents of a language that are learned from, at most.
SAMPLE = 160
#: Characters learned of each of them, at most.
EXCERPT = 192
#: Symbols that are parsed in a row.
STRETCH = 2048
#: Stretches that are parsed side by side.
LANES = 4096
UNKNOWN = "und"

#: Letters as they are, other ASCII characters as spaces: digits and marks tell no language.
_ASCII = bytes(c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def plain(text: str) -> bytes:
    """Lower-case letters in UTF-8, with one space for whatever stands between."""
    return b" ".join(text.lower().encode("utf-8", "replace").translate(_ASCII).split())


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def suffix_automaton(text: bytes) -> list[dict[int, int]]:
    """Transitions of each state of the automaton of all substrings of ``text``."""
    after: list[dict[int, int]] = [{}]
    link, length = [-1], [0]
    last = 0
    for symbol in text:
        new = len(after)
        after.append({})
        length.append(length[last] + 1)
        link.append(0)
        at = last
        while at >= 0 and symbol not in after[at]:
            after[at][symbol] = new
            at = link[at]
        if at >= 0:
            to = after[at][symbol]
            if length[to] == length[at] + 1:
                link[new] = to
            else:
                twin = len(after)
                after.append(dict(after[to]))
                length.append(length[at] + 1)
                link.append(link[to])
                link[to] = link[new] = twin
                while at >= 0 and after[at].get(symbol) == to:
                    after[at][symbol] = twin
                    at = link[at]
        last = new
    return after


def parse_table(text: bytes, symbols: np.ndarray, width: int) -> np.ndarray:
    """For (state, symbol) the next state's offset, times two, plus one where a new phrase begins.

    ``symbols`` numbers bytes from 1; 0 is any byte that was not learned, a phrase of its own.  The last
    symbol, ``width - 1``, fills the end of short stretches and counts for nothing.
    """
    after = suffix_automaton(text)
    first = np.ones(width, np.int32)
    for symbol, to in after[0].items():
        first[symbols[symbol]] = 2 * to * width + 1
    table = np.tile(first, (len(after), 1))
    for state, found in enumerate(after):
        for symbol, to in found.items():
            table[state, symbols[symbol]] = 2 * to * width + (state == 0)
    table[:, width - 1] = 0
    return table.reshape(-1)


class Parser:
    """The automata of all languages, by name."""

    def __init__(self, learned: dict[str, bytes]):
        # A language nothing was learned of would need no bits, and win every text.
        self.names = sorted(name for name, text in learned.items() if text.strip())
        seen = sorted(set(b"".join(learned.values())))
        self.symbols = np.zeros(256, np.uint8)
        self.symbols[seen] = np.arange(1, len(seen) + 1)
        self.width = len(seen) + 2
        self.tables = [parse_table(learned[n], self.symbols, self.width) for n in self.names]
        self.bits = np.array([np.log2(len(learned[n]) + 1) for n in self.names])

    def phrases(self, texts: list[bytes]) -> np.ndarray:
        """(texts, languages) numbers of phrases."""
        lanes = [(i, t[a : a + STRETCH]) for i, t in enumerate(texts) for a in range(0, len(t), STRETCH)]
        lanes.sort(key=lambda lane: -len(lane[1]))
        counts = np.zeros((len(texts), len(self.names)), np.int64)
        for a in range(0, len(lanes), LANES):
            some = lanes[a : a + LANES]
            sizes = np.array([len(t) for _, t in some])
            grid = np.full((len(some), sizes[0]), self.width - 1, np.int32)
            grid[np.arange(sizes[0]) < sizes[:, None]] = self.symbols[
                np.frombuffer(b"".join(t for _, t in some), np.uint8)
            ]
            steps = np.ascontiguousarray(grid.T)
            alive = np.searchsorted(-sizes, -np.arange(sizes[0]), "left")
            owners = np.array([i for i, _ in some])
            for n, table in enumerate(self.tables):
                state = np.zeros(len(some), np.int32)
                found = np.zeros(len(some), np.int32)
                for step, live in zip(steps, alive.tolist(), strict=True):
                    now = table.take(state[:live] + step[:live])
                    found[:live] += now & 1
                    state[:live] = now >> 1
                np.add.at(counts[:, n], owners, found)
        return counts

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        names, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
        known = [i for i, t in enumerate(texts) if has_letter(t)] if self.names else []
        counts = self.phrases([plain(texts[i]) for i in known])
        for i, row in zip(known, counts * self.bits, strict=True):
            best = int(row.argmin())
            names[i] = self.names[best]
            scores[i] = 1 - row[best] / np.delete(row, best).min(initial=np.inf)
        return names, scores


@lru_cache(maxsize=1)
def _parser(learned: tuple[tuple[str, bytes], ...]) -> Parser:
    return Parser(dict(learned))


def learn(
    documents: DataFrame, chosen: Column, key: str = "doc_id", text: str = "text", lang: str = "lang"
) -> tuple[tuple[str, bytes], ...]:
    """The text learned of each language: ``SAMPLE`` excerpts at most."""
    rows = documents.filter(chosen).select(
        F.col(lang).cast("string").alias("lang"), F.col(text).cast("string").alias("text"),
        F.xxhash64(F.col(key)).alias("place"),
    ).filter(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    begin = F.pmod("place", F.greatest(F.length("text") - EXCERPT, F.lit(0)) + 1) + 1
    excerpt = F.substring(F.col("text"), begin.cast("int"), F.lit(EXCERPT)).alias("excerpt")
    # Each task hands on its first SAMPLE rows of a language only.
    order = Window.partitionBy("lang").orderBy("place", "excerpt")
    kept = (
        rows.select("lang", "place", excerpt)
        .withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= SAMPLE)
    )
    texts: dict[str, list[bytes]] = {}
    for row in kept.select("lang", "rank", "excerpt").orderBy("lang", "rank").collect():
        texts.setdefault(row["lang"], []).append(plain(row["excerpt"]))
    return tuple((name, b" ".join(found)) for name, found in texts.items())


def identify(
    documents: DataFrame, learned: tuple[tuple[str, bytes], ...], text: str = "text"
) -> DataFrame:
    """The columns of ``documents`` and lang_pred and score, from the text alone."""
    shared = documents.sparkSession.sparkContext.broadcast(learned)

    def predict(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        parser = _parser(shared.value)
        for part in parts:
            names, scores = parser.predict([t if isinstance(t, str) else None for t in part])
            yield pd.DataFrame({"lang_pred": pd.Series(names, dtype=object), "score": scores})

    found = F.pandas_udf(predict, "lang_pred string, score double")
    kept = [F.col(f"`{c}`") for c in documents.columns if c not in ("lang_pred", "score", "_found")]
    return documents.select(*kept, found(F.col(text).cast("string")).alias("_found")).select(
        *kept, F.col("_found.lang_pred").alias("lang_pred"), F.col("_found.score").alias("score")
    )
