"""Frequent phrases by dynamic itemset counting, and their score as collocations.

Texts are lower-cased (A-Z), split into pieces at ``.,;:!?`` and the controls 0x0A-0x0D, and pieces into
words at spaces and tabs.  The corpus is written as ``shards`` parts, which are scanned one after the other,
round and round.  A step of the scan counts phrases of all lengths at once: single words from the first
step on, a longer phrase from the first step on at whose beginning both its subphrases (all but its last
and all but its first word) have been counted ``least`` times.  Every phrase is counted for one full round
from the step it began at, so its count is whole; the scan ends once no phrase is left to count.

Which subphrases have reached the threshold is told to the tasks by a bit filter of fixed size
(``filter_bits``), one for the step and one for the step a round ago: a phrase is counted if the first
lets it pass and the second does not.  Filters only gain bits, so each phrase has one first step, and is
counted from there for exactly one round.  A false positive of the filter costs a phrase counted in vain,
never a count.  A larger corpus wants more bits; with too few, more phrases are counted, with equal results.

Counts are kept by 61-bit hashes of (language, words) and the number of words, up to 8; phrases that reached the threshold get their text
in a last scan, in slices that double, so that later ones spell only what earlier ones lack.  (With 10^6 frequent phrases among 10^9 counted ones, one of them shares its hash with another in
fewer than one of 10^3 corpora.)

A phrase of 2 or more words is cut into two parts wherever it can be; a cut's score is its count a against
the counts l and r of the parts, ``2000000 * a / (l + r)`` floored, and the phrase's the lowest of its
cuts'.  A phrase within a longer one that has 80 % of its count is dropped.  All of it is exact in
decimals.  Null texts hold no words, a null language counts as ``und``, rows are counted one by one
whatever they repeat, other columns are not read, and an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stackroom.llm.ranking import placed
from stackroom.llm.store import stored
from stackroom.llm.words import mixed, utf8
from stackroom.session import remove_scratch, scratch_dir

UNKNOWN = "und"
#: Bytes of text a task takes at a time, and keys it gathers before it counts them.
LOT = 1 << 18
GATHERED = 1 << 20

_WORD, _GAP, _BREAK = 0, 1, 2
_CLASS = np.zeros(256, np.uint8)
_CLASS[[0x20, 0x09]] = _GAP
_CLASS[[*b".,;:!?", 0x0A, 0x0B, 0x0C, 0x0D]] = _BREAK
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_FACTOR = 0x9E3779B97F4A7C13
_INVERSE = pow(_FACTOR, -1, 1 << 64)
_STEP = np.uint64(0xD6E8FEB86659FD93)
_SIZE = np.uint64(7)
_PROBE = np.uint64(0xA0761D6478BD642F)
_VALUES = np.random.default_rng(20240311).integers(1, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
#: What a byte of a text adds to a word's hash: nothing between words, the same in either case.
_WORD_VALUES = np.where(_CLASS == _WORD, _VALUES[_LOWER], np.uint64(0))


@dataclass(frozen=True)
class Settings:
    most: int = 4
    least: int = 30
    shards: int = 3
    filter_bits: int = 26


def _powers(factor: int, size: int) -> np.ndarray:
    out = np.full(size, factor, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


_UP, _DOWN = _powers(_FACTOR, 2 * LOT), _powers(_INVERSE, 2 * LOT)


def _of(powers: np.ndarray, factor: int, size: int) -> np.ndarray:
    return powers[:size] if size <= len(powers) else _powers(factor, size)


def _language_hash(text: str) -> int:
    """Unlike the hash of a word of the same letters, which it is combined with."""
    data = np.frombuffer(text.encode(), np.uint8)
    total = int((_VALUES[data] * _powers(_FACTOR, len(data))).sum(dtype=np.uint64)) if len(data) else 0
    return int(mixed(mixed(np.array([total], np.uint64)) + _PROBE)[0])


def _sized(keys: np.ndarray, n: int) -> np.ndarray:
    """Keys whose last bits say how many words the phrase has."""
    return (keys & ~_SIZE) | np.uint64(n - 1)


class _Words:
    """The words of some texts: where they are, their hashes, and which follow each other in a piece."""

    def __init__(self, texts: list[bytes], langs: np.ndarray):
        self.buffer = np.frombuffer(b"\n".join([*texts, b""]), np.uint8)
        classes = _CLASS[self.buffer]
        inside = classes == _WORD
        edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
        if len(inside) and inside[0]:
            edges = np.r_[0, edges]
        self.starts, self.ends = edges[0::2], edges[1::2]
        size = len(self.buffer)
        sums = np.cumsum(_WORD_VALUES[self.buffer] * _of(_UP, _FACTOR, size))
        before = np.where(self.starts > 0, sums[self.starts - 1], np.uint64(0))
        hashes = (sums[self.ends - 1] - before) * _of(_DOWN, _INVERSE, size)[self.starts]
        self.hashes = mixed(hashes + (self.ends - self.starts).astype(np.uint64))
        self.piece = np.cumsum(classes == _BREAK, dtype=np.int32)[self.starts]
        borders = np.cumsum([0, *(len(t) + 1 for t in texts)])
        self.per_text = np.diff(np.searchsorted(self.starts, borders))
        self.langs = np.repeat(langs, self.per_text)

    def first_keys(self) -> np.ndarray:
        return _sized(mixed(self.hashes ^ self.langs), 1)

    def spelled(self, begins: np.ndarray, n: int) -> pa.Array:
        """Phrases of n words, lower-cased, with one space between words."""
        keep = _CLASS[self.buffer] == _WORD
        keep[self.ends] = True  # one byte behind every word
        text = _LOWER[self.buffer[keep]]
        lengths = self.ends - self.starts
        stops = np.cumsum(lengths + 1) - 1
        text[stops] = 0x20
        first = (stops - lengths)[begins]
        sizes = stops[begins + (n - 1)] - first
        offsets = np.r_[0, np.cumsum(sizes)]
        places = np.repeat(first - offsets[:-1], sizes) + np.arange(offsets[-1])
        return pa.StringArray.from_buffers(
            len(begins), pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(text[places])
        )

    def adjacent(self) -> np.ndarray:
        """Whether a word is followed by another of its piece."""
        return self.piece[1:] == self.piece[:-1]


def _passes(bits: np.ndarray, width: int, keys: np.ndarray) -> np.ndarray:
    found = np.ones(len(keys), bool)
    for places in _places(keys, width):
        found &= (bits.take((places >> np.uint64(3)).astype(np.int64)) >> (places & np.uint64(7)).astype(np.uint8)) & 1 > 0
    return found


def _places(keys: np.ndarray, width: int) -> Iterator[np.ndarray]:
    shift = np.uint64(64 - width)
    yield keys >> shift
    yield (keys * _PROBE) >> shift


def _lots(batch: pa.RecordBatch, hashes: dict) -> Iterator[tuple[list[bytes], list[str], np.ndarray]]:
    """(texts, languages, their hashes), LOT bytes at a time or one longer text."""
    texts, langs = utf8(batch, "text"), batch.column(batch.schema.get_field_index("lang")).to_pylist()
    if len(hashes) > 10000:
        hashes.clear()
    held: list[bytes] = []
    named: list[str] = []
    size = 0
    for text, lang in zip(texts, langs, strict=True):
        if lang not in hashes:
            hashes[lang] = _language_hash(lang)
        if held and size + len(text) > LOT:
            yield held, named, np.array([hashes[n] for n in named], np.uint64)
            held, named, size = [], [], 0
        held.append(text)
        named.append(lang)
        size += len(text) + 1
    if held:
        yield held, named, np.array([hashes[n] for n in named], np.uint64)


def _levels(
    words: _Words, now: np.ndarray, ago: np.ndarray | None, settings: Settings
) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(length, first words, keys, whether a round ago lets them pass) of what the filter ``now`` lets pass.

    A longer phrase passes if both its subphrases pass and are in the filter.
    """
    keys, width = words.first_keys(), settings.filter_bits
    begins, old = np.arange(len(keys)), np.full(len(keys), ago is not None)
    joined = words.adjacent()
    for n in range(2, settings.most + 1):
        passed = _passes(now, width, keys)
        both = passed[1:] & passed[:-1] & joined
        pairs = np.flatnonzero(both)
        if not len(pairs):
            return
        if ago is not None:
            old[passed] &= _passes(ago, width, keys[passed])
            old = old[pairs] & old[pairs + 1]
        else:
            old = np.zeros(len(pairs), bool)
        begins = begins[pairs]
        keys = _sized(mixed(keys[pairs] * _STEP + words.hashes[begins + (n - 1)]), n)
        yield n, begins, keys, old
        # Phrases one word apart overlap, so what they span is in one piece.
        joined = begins[1:] == begins[:-1] + 1


def _count_step(shard: DataFrame, now, ago, first_round: bool, settings: Settings) -> DataFrame:
    """(key, n) of the phrases a step counts, some keys more than once.

    ``now`` and ``ago`` are the filters of this step and of the one a round ago; None if nothing passes.
    """

    def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here = None if now is None else np.frombuffer(now.value, np.uint8)
        before = None if ago is None else np.frombuffer(ago.value, np.uint8)
        held: list[np.ndarray] = []
        size = 0
        hashes: dict[str, int] = {}

        def flushed() -> pa.RecordBatch:
            keys, counts = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays(
                [pa.array(keys.view(np.int64)), pa.array(counts.astype(np.int64))], names=["key", "n"]
            )

        for batch in batches:
            for texts, _, langs in _lots(batch, hashes):
                words = _Words(texts, langs)
                if first_round:
                    held.append(words.first_keys())
                    size += len(held[-1])
                if here is not None:
                    for _, _, keys, old in _levels(words, here, before, settings):
                        held.append(keys[~old])
                        size += len(held[-1])
                if size >= GATHERED:
                    yield flushed()
                    held, size = [], 0
        if size:
            yield flushed()

    return shard.mapInArrow(per_task, "key bigint, n bigint")


def _spelled(corpus: DataFrame, reached, wanted, settings: Settings) -> DataFrame:
    """key, lang, phrase, length of phrases that the filter ``wanted`` lets pass, and the words of each language.

    Longer phrases are made of what ``reached`` lets pass.  Each phrase comes once for each task; the rows
    that count words have the length 0.
    """

    names = ["key", "lang", "phrase", "length", "words"]

    def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, needed = np.frombuffer(reached.value, np.uint8), np.frombuffer(wanted.value, np.uint8)
        seen, fresh = np.zeros(0, np.uint64), []
        hashes: dict[str, int] = {}
        for batch in batches:
            for texts, named, langs in _lots(batch, hashes):
                words = _Words(texts, langs)
                codes = np.repeat(np.arange(len(texts)), words.per_text)
                counted: dict[str, int] = {}
                for lang, n in zip(named, words.per_text.tolist(), strict=True):
                    counted[lang] = counted.get(lang, 0) + n
                none = pa.nulls(len(counted))
                yield pa.RecordBatch.from_arrays(
                    [none.cast(pa.int64()), pa.array(list(counted), pa.string()), none.cast(pa.string()),
                     pa.array(np.zeros(len(counted), np.int32)), pa.array(list(counted.values()), pa.int64())],
                    names=names,
                )
                spoken = np.array(named, object)
                found = [(1, np.arange(len(codes)), words.first_keys())]
                found += [level[:3] for level in _levels(words, bits, None, settings)]
                for n, begins, keys in found:
                    good = np.flatnonzero(_passes(needed, settings.filter_bits, keys))
                    if len(seen):
                        at = np.minimum(np.searchsorted(seen, keys[good]), len(seen) - 1)
                        good = good[seen[at] != keys[good]]
                    new, where = np.unique(keys[good], return_index=True)
                    if not len(new):
                        continue
                    fresh.append(new)
                    first = begins[good[where]]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(new.view(np.int64)), pa.array(spoken[codes[first]], pa.string()),
                         words.spelled(first, n), pa.array(np.full(len(new), n, np.int32)),
                         pa.array(np.zeros(len(new), np.int64))],
                        names=names,
                    )
                seen = np.sort(np.concatenate([seen, *fresh]))
                fresh = []

    return corpus.mapInArrow(per_task, "key bigint, lang string, phrase string, length int, words bigint")


def _filter_bytes(counts: DataFrame, least: int, width: int, longest: int, before) -> bytes:
    """Bit filter of the phrases of up to ``longest`` words counted often enough.

    ``before`` is the filter to add to, if there is one.  What is new is gathered as blocks of bytes: the
    filter's size is fixed.
    """
    block = 1 << max(0, width - 3 - 10)

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(1 << (width - 3), np.uint8)
        old = None if before is None else np.frombuffer(before.value, np.uint8)
        for batch in batches:
            keys = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            if old is not None:
                keys = keys[~_passes(old, width, keys)]
            for places in _places(keys, width):
                np.bitwise_or.at(bits, (places >> np.uint64(3)).astype(np.int64),
                                 np.uint8(1) << (places & np.uint64(7)).astype(np.uint8))
        for i in range(len(bits) // block):
            part = bits[i * block : (i + 1) * block]
            if part.any():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([i], pa.int32()), pa.array([part.tobytes()], pa.binary())], names=["i", "bits"]
                )

    def merged(key: tuple, parts: pa.Table) -> pa.Table:
        bits = np.zeros(block, np.uint8)
        for part in parts.column("bits").to_pylist():
            bits |= np.frombuffer(part, np.uint8)
        return pa.table({"i": pa.array([key[0].as_py()], pa.int32()), "bits": pa.array([bits.tobytes()], pa.binary())})

    schema = "i int, bits binary"
    short = F.col("key").bitwiseAND(F.lit(int(_SIZE))) < longest
    reached = counts.filter((F.col("n") >= least) & short).select("key")
    whole = np.zeros(1 << (width - 3), np.uint8)
    if before is not None:
        whole |= np.frombuffer(before.value, np.uint8)
    for row in reached.mapInArrow(blocks, schema).groupBy("i").applyInArrow(merged, schema).collect():
        whole[row["i"] * block : (row["i"] + 1) * block] |= np.frombuffer(row["bits"], np.uint8)
    return whole.tobytes()


def _write_shards(docs: DataFrame, text: str, lang: str, shards: int) -> tuple[str, int]:
    """The folder of the corpus in shards, and in how many slices each is.

    The first slices are small, each later one is as large as all before it: 1, 1, 2, 4, ... parts.  The
    first holds about as much as eight of the partitions read.
    """
    folder = scratch_dir(docs.sparkSession, "shards")
    doublings = max(0, math.ceil(math.log2(max(1, docs.rdd.getNumPartitions()) / 8)))
    part = F.pmod(F.shiftright("dealt", 32), F.lit(1 << doublings))
    # A row's number is a column first: used in two places, each counts the rows that come to it.
    rows = docs.select(
        F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit(UNKNOWN)).alias("lang"),
        F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"),
        F.xxhash64(F.monotonically_increasing_id()).alias("dealt"),
    ).select(
        "lang", "text",
        F.pmod("dealt", F.lit(shards)).cast("int").alias("shard"),
        F.when(part == 0, 0).otherwise(F.length(F.bin(part))).cast("int").alias("slice"),
    )
    rows.write.partitionBy("shard", "slice").parquet(folder)
    return folder, doublings + 1


def _read_shards(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema("lang string, text string, shard int, slice int").parquet(folder)


def frequent_phrases(
    docs: DataFrame, settings: Settings = Settings(), text: str = "text", lang: str = "lang"
) -> DataFrame:
    """lang, phrase, length in words, n: every phrase counted ``least`` times or more, and with length 0
    and a null phrase the number of words of each language."""
    spark = docs.sparkSession
    folder, slices = _write_shards(docs, text, lang, settings.shards)
    corpus = _read_shards(spark, folder)
    filters: list[bytes | None] = [None]  # what each step begins with
    sent: list = [None]
    counts, written, step = None, None, 0
    while step < settings.shards or filters[step] != filters[step - settings.shards]:
        ago = step - settings.shards
        found = _count_step(
            corpus.filter(F.col("shard") == step % settings.shards).select("lang", "text"),
            sent[step], sent[ago] if ago >= 0 else None, step < settings.shards, settings,
        ).withColumn("since", F.lit(step))
        if counts is not None:
            found = found.unionByName(counts)
        # Tasks have counted their own; hardly a key comes twice before the shuffle.
        summed = (
            found.repartition("key").groupBy("key")
            .agg(F.sum("n").alias("n"), F.min("since").alias("since"))
        )
        # What ends its round below the threshold is let go before it is written.
        summed = summed.filter((F.col("n") >= settings.least) | (F.col("since") > ago + 1))
        before, written = written, scratch_dir(spark, "phrase-counts")
        # Hashes hardly repeat: a dictionary of them would be built in vain.
        summed.write.option("parquet.enable.dictionary#key", "false").parquet(written)
        counts = spark.read.schema("key bigint, n bigint, since int").parquet(written)
        if before:
            remove_scratch(before)
        if ago >= 0 and sent[ago] is not None:
            sent[ago].destroy()
            sent[ago] = None
        if ago > 0:
            filters[ago - 1] = None
        step += 1
        filters.append(_filter_bytes(counts, settings.least, settings.filter_bits, settings.most - 1, sent[-1]))
        sent.append(spark.sparkContext.broadcast(filters[step]))
    reached = _filter_bytes(counts, settings.least, settings.filter_bits, settings.most, sent[-1])
    sent.append(spark.sparkContext.broadcast(reached))
    wanted, spelled = sent[-1], None
    # What a slice has spelled the next ones need not: a phrase comes from a few tasks, not from all.
    for part in range(slices):
        here = corpus.filter(F.col("slice") == part).select("lang", "text")
        found = stored(_spelled(here, sent[step + 1], wanted, settings), "phrase-texts")
        spelled = found if spelled is None else spelled.unionByName(found)
        if part + 1 < slices:
            left = counts.join(spelled.filter(F.col("length") > 0).select("key").distinct(), "key", "left_anti")
            bits = _filter_bytes(left, settings.least, settings.filter_bits, settings.most, None)
            wanted = spark.sparkContext.broadcast(bits)
            sent.append(wanted)
    texts = spelled.filter(F.col("length") > 0).groupBy("key").agg(
        F.first(F.struct("lang", "phrase", "length")).alias("t")
    )
    named = counts.filter(F.col("n") >= settings.least).join(texts, "key").select("t.*", "n")
    totals = (
        spelled.filter(F.col("length") == 0)
        .groupBy("lang").agg(F.sum("words").alias("n"))
        .select("lang", F.lit(None).cast("string").alias("phrase"), F.lit(0).alias("length"), "n")
    )
    frequent = stored(named.unionByName(totals), "phrases")
    for used in sent:
        if used is not None:
            used.destroy()
    remove_scratch(folder)
    remove_scratch(written)
    return frequent


def scored(frequent: DataFrame, kept: int | None = 2000) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of the phrases of two or more words, best first.

    ``kept`` is how many of each language are returned; None for all.
    """
    wide = "decimal(38,0)"
    parts = F.split("phrase", " ")
    phrases = frequent.filter(F.col("length") >= 2).select("lang", "phrase", "length", F.col("n").alias("a"))
    part = frequent.filter(F.col("length") >= 1)
    cuts = phrases.select(
        "lang", "phrase", "a", F.explode(F.sequence(F.lit(1), F.col("length") - 1)).alias("k"), parts.alias("w")
    ).select(
        "lang", "phrase", "a", "k",
        F.array_join(F.slice("w", F.lit(1), F.col("k")), " ").alias("left"),
        F.array_join(F.slice("w", F.col("k") + 1, F.size("w") - F.col("k")), " ").alias("right"),
    )
    lefts = part.select("lang", F.col("phrase").alias("left"), F.col("n").alias("l"))
    rights = part.select("lang", F.col("phrase").alias("right"), F.col("n").alias("r"))
    both = cuts.join(lefts, ["lang", "left"]).join(rights, ["lang", "right"])
    score = F.expr(f"(CAST(2000000 AS {wide}) * CAST(a AS decimal(20,0))) DIV CAST(l + r AS decimal(20,0))")
    lowest = both.groupBy("lang", "phrase", "a").agg(
        F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut")
    )
    spans = F.transform(
        F.sequence(F.lit(0), F.col("length") - 2),
        lambda i: F.transform(
            F.sequence(F.lit(2), F.col("length") - i),
            lambda m: F.array_join(F.slice(parts, i + 1, m), " "),
        ),
    )
    within = phrases.filter(F.col("length") > 2).select(
        "lang", F.col("phrase").alias("longer"), F.col("a").alias("f"), F.explode(F.flatten(spans)).alias("phrase")
    ).filter(F.col("longer") != F.col("phrase"))
    holding = within.groupBy("lang", "phrase").agg(F.max("f").alias("f"))
    hidden = F.expr(f"CAST(100 AS {wide}) * CAST(f AS decimal(20,0)) >= CAST(80 AS {wide}) * CAST(a AS decimal(20,0))")
    left = lowest.join(holding, ["lang", "phrase"], "left").filter(F.col("f").isNull() | ~hidden)
    totals = frequent.filter(F.col("length") == 0).select("lang", F.col("n").alias("words"))
    best = stored(left.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score"), "phrase-scores")
    # One order over all languages: a large one is not sorted by one task.
    order = [F.col("lang"), F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    ranked = placed(best, order, "_place")
    first = stored(ranked.groupBy("lang").agg(F.min("_place").alias("_first")).join(totals, "lang"), "langs")
    # One row for each language; a table with more of them than that has them joined.
    first = F.broadcast(first) if first.count() <= 100_000 else first
    ranked = ranked.join(first, "lang").withColumn("rank", F.col("_place") - F.col("_first") + 1)
    if kept is not None:
        ranked = ranked.filter(F.col("rank") <= kept)
    return ranked.select(
        "lang", "rank", "phrase", "a", "l", "r", F.col("words").alias("n"), F.col("score").cast("bigint").alias("score")
    )


def collocations(
    docs: DataFrame, settings: Settings = Settings(), kept: int | None = 2000,
    text: str = "text", lang: str = "lang",
) -> DataFrame:
    """The ``kept`` best phrases of each language."""
    return scored(frequent_phrases(docs, settings, text, lang), kept)
