"""Benchmark decontamination by spaced-seed hashing.

Fixed masks choose tokens to look at and ignore the ones between, so a seed survives a substituted
token that it ignores.  Hashes of all masks at all places of the benchmark are joined with those of
the documents.  Every hit sets a diagonal (item, shift), along which tokens are compared: a document
is contaminated where in some ``WINDOW`` tokens of one diagonal at most ``SUBSTITUTIONS`` differ.  The masks
hit every such window, whichever of its tokens are substituted, and so does that of shorter items, for which one
mask more is used; a test tries all.

Items are handled in blocks of about ``BLOCK_TOKENS`` tokens, whose index has a size bound and is sent
to all tasks.  Documents are read once for each block and never shuffled: every row is judged where it is,
by its text alone.  So neither a common passage nor a hot source or key gathers documents anywhere.

Tokens are words, lower-cased in every script, without common marks, split at white space as in
``words`` and compared by 64-bit hashes.

Defined results: null and empty texts of documents are clean; items shorter than ``WINDOW`` tokens must agree in
all but the same share of them; items of fewer than ``LEAST`` tokens, null ones included, tell too little and
are not looked for; equal items are found alike; an item without an id is looked for as any other and told as
null; items that share an id but not their text count as several.  Rows that share a key, or have none, are judged
each by its own text.  Columns of documents may have any name; texts are used whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stackroom.llm.store import stored
from stackroom.llm.words import hashed_words, mixed

#: Tokens looked at, from a seed's first.
MASKS = ("11111", "1110101", "1101011", "11001011")
#: One more for items of fewer than ``WINDOW`` tokens.
SHORT_MASK = "10110011"
WINDOW = 13
SUBSTITUTIONS = 3
LEAST = 8
#: Tokens of a block of items, about: its index has 12 bytes for each token and mask.
BLOCK_TOKENS = 500_000
#: Marks that do not count.
MARKS = ".,;:!?\"'()|*"
#: Bits of the map of hashes that a block has, looked at before its index.
MAP_BITS = 25


def _plain(text: Column) -> Column:
    return F.translate(F.lower(text.cast("string")), MARKS, "")


def _offsets(mask: str) -> list[int]:
    return [i for i, c in enumerate(mask) if c == "1"]


def seeds(tokens: np.ndarray, bounds: np.ndarray, mask: str, number: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and place of a mask at all its places within texts, that are ``bounds`` of ``tokens``."""
    offsets = _offsets(mask)
    count = len(tokens) - offsets[-1]
    if count <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    hashes = np.full(count, number + 1, np.uint64)
    for offset in offsets:
        hashes *= np.uint64(0xD6E8FEB86659FD93)
        hashes += tokens[offset : offset + count]
    # Places that reach beyond their text's end.
    inside = np.ones(len(tokens), bool)
    for back in range(1, offsets[-1] + 1):
        at = bounds[1:] - back
        inside[at[at >= bounds[:-1]]] = False
    places = np.flatnonzero(inside[:count])
    return mixed(hashes[places]), places


class Index:
    """Seeds of a block of items."""

    def __init__(self, items: list[int | None], texts: list[bytes | None]):
        tokens, bounds = hashed_words(texts)
        self.items = items
        self.tokens, self.bounds = tokens, bounds
        sizes = np.diff(bounds)
        long, short = sizes >= LEAST, (sizes >= LEAST) & (sizes < WINDOW)
        self.masks = [*MASKS, SHORT_MASK] if short.any() else MASKS
        hashes, places = [], []
        for number, mask in enumerate(self.masks):
            h, p = seeds(tokens, bounds, mask, number)
            wanted = long if number < len(MASKS) else short
            kept = wanted[np.searchsorted(bounds, p, "right") - 1] if len(p) else np.zeros(0, bool)
            hashes.append(h[kept])
            places.append(p[kept])
        every, places = np.concatenate(hashes), np.concatenate(places)
        order = np.argsort(every, kind="stable")
        self.places = places[order].astype(np.int32)
        self.hashes, self.starts = np.unique(every[order], return_index=True)
        self.starts = np.r_[self.starts, len(every)].astype(np.int32)
        bits = np.zeros(1 << MAP_BITS, bool)
        bits[(self.hashes >> np.uint64(64 - MAP_BITS)).astype(np.int64)] = True
        self.map = np.packbits(bits, bitorder="little")

    def hits(self, tokens: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(place in the documents, place in the items) of equal seeds, a mask at a time."""
        for number, mask in enumerate(self.masks):
            hashes, places = seeds(tokens, bounds, mask, number)
            cell = hashes >> np.uint64(64 - MAP_BITS)
            byte = self.map[(cell >> np.uint64(3)).astype(np.int64)]
            maybe = np.flatnonzero(byte >> (cell & np.uint64(7)).astype(np.uint8) & 1)
            if not len(maybe) or not len(self.hashes):
                continue
            hashes, places = hashes[maybe], places[maybe]
            at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
            found = self.hashes[at] == hashes
            at, places = at[found], places[found]
            counts = self.starts[at + 1] - self.starts[at]
            first = np.repeat(self.starts[at] - np.r_[0, np.cumsum(counts)[:-1]], counts)
            yield np.repeat(places, counts), self.places[first + np.arange(counts.sum())].astype(np.int64)

    def overlaps(self, tokens: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
        """(text, item, begin in the text, end) of every verified overlap."""
        pairs = [np.stack(found) for found in self.hits(tokens, bounds)]
        if not pairs:
            return
        at, place = np.concatenate(pairs, axis=1)
        text = np.searchsorted(bounds, at, "right") - 1
        item = np.searchsorted(self.bounds, place, "right") - 1
        for t, i, shift in np.unique(np.stack([text, item, at - place]), axis=1).T.tolist():
            low = max(int(self.bounds[i]), int(bounds[t]) - shift)
            high = min(int(self.bounds[i + 1]), int(bounds[t + 1]) - shift)
            width = min(WINDOW, int(self.bounds[i + 1] - self.bounds[i]))
            if high - low < width:
                continue
            equal = self.tokens[low:high] == tokens[low + shift : high + shift]
            sums = np.r_[0, np.cumsum(equal)]
            enough = width - SUBSTITUTIONS * width // WINDOW
            good = np.flatnonzero(sums[width:] - sums[:-width] >= enough)
            if len(good):
                begin = low + shift - int(bounds[t])
                yield t, i, begin + int(good[0]), begin + int(good[-1]) + width


def _blocks(benchmark: DataFrame, item: str, text: str) -> Iterator[Index]:
    """The items, a block at a time; an item of any length is in one block whole."""
    items = benchmark.select(
        F.col(item).cast("long").alias("item"), _plain(F.col(text)).alias("text")
    ).filter("text is not null")
    items = stored(items.distinct(), "benchmark-items")
    tokens = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, -(-tokens // (4 * BLOCK_TOKENS)))
    # Dealt by both, so that neither a common id nor a common text fills a block.
    at = F.pmod(F.xxhash64("item", "text"), F.lit(blocks))
    for block in range(blocks):
        rows = items.filter(at == block).collect()
        yield Index([r["item"] for r in rows], [r["text"].encode() for r in rows])


_OVERLAP = "array<struct<item: bigint, number: bigint, begin: bigint, end: bigint>>"


def _finder(spark, index: Index):
    """A function of a plain text: its verified overlaps with the items of a block."""
    shared = spark.sparkContext.broadcast(index)

    def search(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        index = shared.value
        for part in parts:
            texts = [t.encode() if isinstance(t, str) else None for t in part]
            found: list[list[dict]] = [[] for _ in texts]
            for t, i, begin, end in index.overlaps(*hashed_words(texts)):
                found[t].append({"item": index.items[i], "number": i, "begin": begin, "end": end})
            yield pd.Series(found, dtype=object)

    return F.pandas_udf(search, _OVERLAP)


def overlaps(
    documents: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text",
    item: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """key, item, begin and end (in tokens of the document) of every verified overlap."""
    spark = documents.sparkSession
    rows = documents.select(F.col(key).alias("key"), _plain(F.col(text)).alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    result = spark.createDataFrame([], f"key {kind}, item long, begin long, end long")
    for index in _blocks(benchmark, item, item_text):
        found = rows.select("key", F.explode(_finder(spark, index)(F.col("text"))).alias("o"))
        told = found.select("key", "o.item", "o.begin", "o.end")
        result = result.unionByName(stored(told, "benchmark-overlaps"))
    return result


def _judged(
    documents: DataFrame, benchmark: DataFrame, keep: list[str], text: str, item: str, item_text: str
) -> DataFrame:
    """``keep`` as _0, _1, …, _n_items, _length and _item of the longest overlap of every row."""
    spark = documents.sparkSession
    names = [f"_{i}" for i in range(len(keep))]
    nothing = F.lit(0).cast("long")
    rows = documents.select(
        *[F.col(f"`{c}`").alias(n) for c, n in zip(keep, names, strict=True)],
        _plain(F.col(f"`{text}`")).alias("_text"),
        nothing.alias("_n_items"), nothing.alias("_length"), F.lit(None).cast("long").alias("_item"),
    )
    length = lambda o: o["end"] - o["begin"]
    for number, index in enumerate(_blocks(benchmark, item, item_text)):
        if number:
            # One block's index at a time is in the memory of a task.
            rows = stored(rows, "benchmark-blocks")
        found = rows.withColumn("_found", _finder(spark, index)(F.col("_text")))
        # The longest one first, of equal ones that with the smallest id; items without an id come last.
        best = F.array_min(
            F.transform("_found", lambda o: F.struct(
                (-length(o)).alias("l"), o["item"].isNull().alias("none"), o["item"].alias("item")
            ))
        )
        rows = found.withColumn("_best", best).withColumn(
            "_more", F.size(F.array_distinct(F.transform("_found", lambda o: o["number"])))
        )
        longer = F.col("_best.l") < -F.col("_length")
        alike = F.col("_best.l") == -F.col("_length")
        smaller = F.col("_best.item").isNotNull() & (
            F.col("_item").isNull() | (F.col("_best.item") < F.col("_item"))
        )
        better = F.col("_best").isNotNull() & (longer | (alike & smaller))
        rows = rows.select(
            *names, "_text", (F.col("_n_items") + F.col("_more")).alias("_n_items"),
            F.when(better, -F.col("_best.l")).otherwise(F.col("_length")).alias("_length"),
            F.when(better, F.col("_best.item")).otherwise(F.col("_item")).alias("_item"),
        )
    return rows


def clean(
    documents: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text",
    item: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """The rows of ``documents`` that are not contaminated; ``key`` plays no part."""
    rows = _judged(documents, benchmark, documents.columns, text, item, item_text)
    return rows.filter("_n_items = 0").select(
        *[F.col(f"_{i}").alias(c) for i, c in enumerate(documents.columns)]
    )


def marked(
    documents: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text",
    item: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """key, contaminated, n_items, item_id (of the longest overlap, then the smallest) and tokens (of that

    overlap) of every row of ``documents``.
    """
    rows = _judged(documents, benchmark, [key], text, item, item_text)
    found = F.col("_n_items") > 0
    return rows.select(
        F.col("_0").alias(key), found.alias("contaminated"), F.col("_n_items").alias("n_items"),
        F.col("_item").alias("item_id"), F.when(found, F.col("_length")).alias("tokens"),
    )
