"""Resampling of a corpus towards a target: importance weights of hashed n-grams.

Words are runs of 0-9, a-z and bytes from 0x80 on, after A-Z are lower-cased; a document's features are
its runs of ``least`` to ``most`` words joined by one space.  A feature's bucket is its CRC-32 modulo the
number of buckets.  Each document is scanned once, words normalised to one space between them, and
running registers are kept at its words; checksums of all its runs come from pairs of registers
(``running_crc``).  Buckets are stored, so that counting and weighing do not read texts again.

A bucket's gain is its log ratio between target and corpus, add-one smoothed, in thousandths.  A
document's weight is the floored mean of its features' gains; adding Gumbel noise, drawn from a hash of its
key, and taking the highest scores draws without replacement in proportion to the weights' exponentials.

Null and empty texts have no features and weight 0.  A null key is hashed as the empty text and comes last
among ties.  Rows are judged one by one, whatever key they share: copies with one key score alike and
are ranked one after the other.  Other columns are not read.  An empty corpus gives no rows; with an empty
target all gains come from the corpus alone.  Nothing of the size of the corpus reaches the driver: counts
are one number for each bucket, ranks are counted over ranges of scores.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stackroom.llm.ranking import placed
from stackroom.llm.running_crc import one_byte, run_checksums, scan
from stackroom.llm.store import stored
from stackroom.llm.words import utf8

#: Bytes scanned at a time; a longer text is cut between words, its registers run on.
LOT = 1 << 20

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_INSIDE = np.zeros(256, bool)
_INSIDE[48:58] = _INSIDE[65:91] = _INSIDE[97:123] = _INSIDE[128:] = True


@dataclass(frozen=True)
class Features:
    least: int = 1
    most: int = 1
    buckets: int = 10000

    @property
    def width(self) -> type:
        return np.uint16 if self.buckets <= 1 << 16 else np.uint32


@dataclass
class _Words:
    """Registers and places around the words of a batch, and where each text's words begin."""

    before: np.ndarray
    after: np.ndarray
    begins: np.ndarray
    ends: np.ndarray
    bounds: np.ndarray


def _cut(text: bytes) -> Iterator[bytes]:
    """A text in pieces of about LOT bytes, cut behind words."""
    at = 0
    while at < len(text):
        end = at + LOT
        while end < len(text):
            ahead = np.frombuffer(text, np.uint8, min(len(text) - end, LOT), end)
            outside = np.flatnonzero(~_INSIDE[ahead])
            if len(outside):
                end += int(outside[0])
                break
            end += len(ahead)
        yield text[at:end]
        at = end


def _lots(texts: list[bytes | None]) -> Iterator[tuple[list[int], list[bytes]]]:
    """(numbers of texts, their pieces) of up to LOT bytes, unless a word is longer."""
    owners, held, size = [], [], 0
    for i, text in enumerate(texts):
        for piece in _cut(text or b""):
            if held and size + len(piece) > LOT:
                yield owners, held
                owners, held, size = [], [], 0
            owners.append(i)
            held.append(piece)
            size += len(piece)
    if held:
        yield owners, held


def _scanned(texts: list[bytes | None]) -> _Words:
    found = [[np.zeros(0, np.uint32)], [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]]
    counts = np.zeros(len(texts), np.int64)
    register, position = 0, 0
    for owners, pieces in _lots(texts):
        data = np.frombuffer(b"\n".join([*pieces, b""]), np.uint8)
        inside = _INSIDE[data]
        edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
        if inside[0]:
            edges = np.r_[0, edges]
        starts, stops = edges[0::2], edges[1::2]
        # One separator is kept behind every word.
        keep = inside.copy()
        keep[stops] = True
        normal = np.where(inside, _LOWER[data], np.uint8(32))[keep]
        ends = np.cumsum(stops - starts + 1) - 1
        begins = ends - (stops - starts)
        first = register
        after, register = scan(normal, ends, first)
        before = np.r_[np.uint32(first), one_byte(after[:-1], 32)][: len(after)]
        for parts, new in zip(found, (before, after, begins + position, ends + position), strict=True):
            parts.append(new)
        position += len(normal)
        borders = np.cumsum([0, *(len(piece) + 1 for piece in pieces)])
        np.add.at(counts, owners, np.diff(np.searchsorted(starts, borders)))
    return _Words(*[np.concatenate(parts) for parts in found], np.r_[0, np.cumsum(counts)])


def feature_buckets(texts: list[bytes | None], features: Features) -> Iterator[tuple[int, np.ndarray]]:
    """For each text the number of its words and the buckets of its runs, shorter runs first."""
    words = _scanned(texts)
    runs = []
    for n in range(features.least, features.most + 1):
        last = max(0, len(words.begins) - n + 1)
        sums = run_checksums(
            words.before[:last], words.after[n - 1 :][:last],
            words.begins[:last], words.ends[n - 1 :][:last],
        )
        runs.append((n, (sums % np.uint32(features.buckets)).astype(features.width)))
    for a, b in zip(words.bounds.tolist(), words.bounds[1:].tolist(), strict=False):
        yield b - a, np.concatenate([found[a : max(a, b - n + 1)] for n, found in runs])


def bucketed(rows: DataFrame, key: str | None, text: str, features: Features) -> DataFrame:
    """``key`` (if named), n_words, n_features and buckets, as little-endian numbers, of every row."""
    names = ([key] if key else []) + ["n_words", "n_features", "buckets"]
    schema = ", ".join(
        ([f"`{key}` {rows.schema[key].dataType.simpleString()}"] if key else [])
        + ["n_words bigint", "n_features bigint", "buckets binary"]
    )

    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words, found = [], []
            for n, buckets in feature_buckets(utf8(batch, text), features):
                n_words.append(n)
                found.append(buckets)
            size = np.dtype(features.width).itemsize
            blob = [f.astype(f"<u{size}").tobytes() for f in found]
            columns = [
                pa.array(n_words, pa.int64()),
                pa.array([len(f) for f in found], pa.int64()),
                pa.array(blob, pa.binary()),
            ]
            if key:
                columns.insert(0, batch.column(batch.schema.get_field_index(key)))
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return rows.select(*([F.col(f"`{key}`")] if key else []), F.col(f"`{text}`")).mapInArrow(per_batch, schema)


def _numbers(batch: pa.RecordBatch, name: str, width: type) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of a column of packed numbers, and where each row's begin."""
    blobs = batch.column(batch.schema.get_field_index(name)).to_pylist()
    size = np.dtype(width).itemsize
    bounds = np.cumsum([0, *(len(b) // size for b in blobs)])
    return np.frombuffer(b"".join(blobs), f"<u{size}"), bounds


def bucket_counts(found: DataFrame, features: Features) -> np.ndarray:
    """Features of all rows in each bucket: one row for each bucket and task, then one for each bucket."""

    def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(features.buckets, np.int64)
        for batch in batches:
            counts += np.bincount(_numbers(batch, "buckets", features.width)[0], minlength=features.buckets)
        (used,) = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(used.astype(np.int32)), pa.array(counts[used])], names=["bucket", "n"]
        )

    rows = found.select("buckets").mapInArrow(per_task, "bucket int, n bigint")
    total = np.zeros(features.buckets, np.int64)
    for row in rows.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        total[row["bucket"]] = row["n"]
    return total


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Log ratio of each bucket's smoothed shares in target and corpus, in floored thousandths."""
    n = len(corpus)
    wanted = (target + 1).astype(float) * float(int(corpus.sum()) + n)
    have = (corpus + 1).astype(float) * float(int(target.sum()) + n)
    return np.floor(1000 * np.log(wanted / have)).astype(np.int64)


def weighed(found: DataFrame, key: str, gain: np.ndarray, features: Features) -> DataFrame:
    """``key``, n_words, n_features and the floored mean gain of every row's features."""
    key_type = found.schema[key].dataType.simpleString()

    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbers, bounds = _numbers(batch, "buckets", features.width)
            sums = np.r_[0, np.cumsum(gain[numbers])]
            n = np.diff(bounds)
            mean = np.where(n > 0, (sums[bounds[1:]] - sums[bounds[:-1]]) // np.maximum(n, 1), 0)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(batch.schema.get_field_index(c)) for c in (key, "n_words", "n_features")),
                 pa.array(mean)],
                names=[key, "n_words", "n_features", "weight"],
            )

    return found.select(f"`{key}`", "n_words", "n_features", "buckets").mapInArrow(
        per_batch, f"`{key}` {key_type}, n_words bigint, n_features bigint, weight bigint"
    )


def noise(key: Column, seed: int) -> Column:
    """Gumbel noise in floored thousandths, the same for a key in every run."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")))
    drawn = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((drawn + 0.5) / 4294967296))).cast("bigint")


def resample(
    docs: DataFrame,
    target: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    target_text: str = "text",
    features: Features = Features(),
    share: tuple[int, int] = (10, 100),
    min_words: int = 20,
    seed: int = 2024,
) -> DataFrame:
    """``key``, n_features, weight, score and rank of every document.

    Of the documents with at least ``min_words`` words, the floored ``share`` with the highest scores are
    drawn and have a rank, from 1; the others' is null.
    """
    found = stored(bucketed(docs, key, text, features), "features")
    wanted = bucket_counts(bucketed(target, None, target_text, features), features)
    gain = gains(bucket_counts(found, features), wanted)
    scores = stored(
        weighed(found, key, gain, features).withColumn(
            "score", F.col("weight") + noise(F.col(f"`{key}`"), seed)
        ),
        "scores",
    )
    enough = F.col("n_words") >= min_words
    drawn = scores.filter(enough).count() * share[0] // share[1]
    by = [F.col("score").desc(), F.col(f"`{key}`").asc_nulls_last()]
    places = placed(scores.filter(enough), by, "rank")
    out = [F.col(f"`{key}`"), "n_features", "weight", "score"]
    return places.select(
        *out, F.when(F.col("rank") <= drawn, F.col("rank")).cast("bigint").alias("rank")
    ).unionByName(scores.filter(~enough).select(*out, F.lit(None).cast("bigint").alias("rank")))


def draw(docs: DataFrame, resampled: DataFrame, key: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` whose key was drawn, all columns kept."""
    chosen = resampled.filter(F.col("rank").isNotNull()).select(F.col(f"`{key}`").alias("_drawn")).distinct()
    return docs.join(chosen, docs[key].eqNullSafe(chosen["_drawn"]), "left_semi")
