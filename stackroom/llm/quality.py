"""Quality classifier: weak labels joined by expectation-maximisation train a linear scorer.

Two things are judged: whether a text is readable prose and whether it is free of abuse.  For
each, several labellers that overlap vote good, bad or nothing:

* prose: shares of symbols, of capital letters, of words that repeat the one before, of distinct
  words; and the given quality labels;
* abuse: whether words of either of two marker lists occur, learned from two halves of the labelled
  sample (one vote, as both learn the same words); and the given toxicity labels.

Votes of all documents are counted by pattern, of which there are at most 3^5.  Expectation-
maximisation over the counts estimates how each labeller, the given label among them, votes on good
and on bad texts, and so the chance that a text of a pattern is good.  These posterior labels, of a
sample of at most ``SAMPLE`` labelled documents and as many others, train linear scorers over hashed
features: a text's distinct words, their first letters, and its shares in classes.  Every document is
scored whole and is accepted if both chances are one half or more.

Nothing but the sample (a documented bound) is gathered in one place; counts cover all documents.

Defined results: a text that is null or has no word is rejected, with null scores; repeated rows get
equal results; a label whose document is missing is not used, of several labels for one document the lowest
quality and highest toxicity count; without labels the other labellers decide, and nothing is abusive.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from operator import eq

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stackroom.llm.store import stored
from stackroom.llm.words import utf8, values

#: Labelled documents that marker lists and scorers learn from, at most; scorers learn from as many others.
SAMPLE = 12_000
BITS = 18
EPOCHS = 4
#: Weight below which a feature counts for nothing (an L1 penalty in training).
PENALTY = 5.0
#: Words whose features a task keeps, in each of its tables.
CACHE_WORDS = 100_000
#: Chance that a given label is right, before any is estimated.
TRUST = 0.98

SYMBOLS = b"%$#&*!|@^~<>{}[]\\=+_"
CAPITALS = bytes(range(65, 91))
LETTERS = CAPITALS + bytes(range(97, 123))

#: Share, whether much of it is bad, below which (or above which) it votes good, and bad beyond.
SHARES = (
    ("symbols", 0.015, 0.04),
    ("capitals", 0.12, 0.30),
    ("repeats", 0.05, 0.20),
    ("sameness", 0.60, 0.85),
)
GOOD, BAD, NOTHING = 1, 0, 2


def shares(text: bytes, words: list[bytes], distinct: set[bytes]) -> tuple[float, ...]:
    """The shares of ``SHARES``.  Sameness is left out (-1) for short texts."""
    letters = len(text) - len(text.translate(None, LETTERS))
    return (
        (len(text) - len(text.translate(None, SYMBOLS))) / max(1, len(text)),
        (len(text) - len(text.translate(None, CAPITALS))) / max(1, letters),
        sum(map(eq, words, words[1:])) / max(1, len(words)),
        1 - len(distinct) / len(words) if 40 <= len(words) <= 2000 else -1.0,
    )


def votes(found: tuple[float, ...]) -> list[int]:
    out = []
    for share, (_, good, bad) in zip(found, SHARES, strict=True):
        out.append(NOTHING if share < 0 or good <= share < bad else GOOD if share < good else BAD)
    return out


def _feature(text: bytes) -> int:
    return xxhash.xxh64_intdigest(text) & ((1 << BITS) - 1)


class _Features(dict):
    """Feature numbers of a word: itself and its first four and five bytes."""

    def __missing__(self, word: bytes) -> tuple[int, int, int]:
        if len(self) >= CACHE_WORDS:
            self.clear()
        found = _feature(b"w" + word), _feature(b"4" + word[:4]), _feature(b"5" + word[:5])
        self[word] = found
        return found


_FEATURES = _Features()


def features(words: set[bytes], found: tuple[float, ...]) -> np.ndarray:
    """Numbers of a text's features, each once."""
    numbers = {n for w in words for n in _FEATURES[w]}
    numbers.update(_feature(b"s%d:%d" % (i, int(20 * s))) for i, s in enumerate(found) if s >= 0)
    return np.fromiter(numbers, np.int32, len(numbers))


def markers(seen: np.ndarray, texts: np.ndarray) -> set[int]:
    """Features at least 30 times as frequent among abusive texts, in 2 % and eight of them or more.

    ``seen`` counts the texts with each feature, clean ones and abusive ones, and ``texts`` all of them.
    """
    good, bad = np.maximum(1, texts)
    often = seen[1] / bad > 30 * (seen[0] + 0.5) / good
    return set(np.nonzero(often & (seen[1] >= max(8, 0.02 * bad)))[0].tolist())


def posteriors(patterns: np.ndarray, counts: np.ndarray, rounds: int = 100) -> np.ndarray:
    """Chance that a text of each vote pattern is good, by expectation-maximisation.

    ``patterns`` is (patterns, labellers) of GOOD, BAD or NOTHING.  It starts from the share of good
    among all votes, with every labeller better than chance, and from the last labeller, the given
    label, where there is one, with a chance of ``TRUST``.  How often it is right is then estimated as
    it is for the others.
    """
    good_votes, bad_votes = (patterns == GOOD).sum(1), (patterns == BAD).sum(1)
    chance = (good_votes + 0.5) / (good_votes + bad_votes + 1.0)
    given = patterns[:, -1]
    chance = np.select([given == GOOD, given == BAD], [TRUST, 1 - TRUST], chance)
    for _ in range(rounds):
        weights = np.stack([(1 - chance) * counts, chance * counts])  # bad, good
        prior = (weights.sum(1) + 1) / (counts.sum() + 2)
        logs = np.repeat(np.log(prior)[:, None], len(patterns), 1)
        for column in patterns.T:
            table = np.stack(
                [np.bincount(column, weights=w, minlength=3) + 0.1 for w in weights]
            )
            table /= table.sum(1, keepdims=True)
            # Whether a labeller speaks at all says nothing about the text.
            spoken = table[:, :2] / table[:, :2].sum(1, keepdims=True)
            logs += np.where(column == NOTHING, 0.0, np.log(spoken)[:, np.minimum(column, 1)])
        chance = 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -500, 500)))
    return chance


def train(rows: list[np.ndarray], targets: np.ndarray, epochs: int = EPOCHS) -> np.ndarray:
    """Weights (last: bias) of a logistic scorer; adaptive steps with an L1 penalty."""
    size = 1 << BITS
    z, n = np.zeros(size + 1), np.zeros(size + 1)
    weights = np.zeros(size + 1)
    alpha, beta = 0.3, 1.0
    rng = np.random.default_rng(0)
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for start in range(0, len(order), 16):
            some = order[start : start + 16]
            numbers = np.concatenate([np.r_[rows[i], size] for i in some])
            at = np.repeat(np.arange(len(some)), [len(rows[i]) + 1 for i in some])
            raw = np.bincount(at, weights=weights[numbers], minlength=len(some))
            chance = 1 / (1 + np.exp(-np.clip(raw, -35, 35)))
            error = (chance - targets[some])[at]
            touched, where = np.unique(numbers, return_inverse=True)
            gradient = np.bincount(where, weights=error)
            squares = gradient**2
            sigma = (np.sqrt(n[touched] + squares) - np.sqrt(n[touched])) / alpha
            z[touched] += gradient - sigma * weights[touched]
            n[touched] += squares
            zt = z[touched]
            slope = (beta + np.sqrt(n[touched])) / alpha
            penalty = np.where(touched == size, 0.0, PENALTY)
            weights[touched] = -np.sign(zt) * np.maximum(np.abs(zt) - penalty, 0) / slope
    return weights


def _texts(batch: pa.RecordBatch) -> Iterator[tuple[bytes, list[bytes], set[bytes]]]:
    for text in utf8(batch, "text"):
        words = (text or b"").lower().split()
        yield text or b"", words, set(words)


def _sample(rows: DataFrame, labels: DataFrame, size: int) -> DataFrame:
    """key, text, quality and toxic of at most ``size`` labelled rows, by the hash of the key."""
    count = labels.count()
    share = min(1.0, 0.95 * size / max(1, count))
    chosen = labels.filter(
        F.pmod(F.xxhash64("key", F.lit(7)), F.lit(1_000_000)) < int(1_000_000 * share)
    ).limit(size)
    # At most `size` rows of three numbers.
    return rows.join(F.broadcast(chosen), "key").dropDuplicates(["key"])


def _others(rows: DataFrame, labels: DataFrame, count: int, size: int) -> DataFrame:
    """key and text of at most ``size`` of ``count`` rows without a label, by the hash of the row, each once."""
    share = min(1.0, 0.95 * size / max(1, count))
    hashed = rows.filter("text is not null").join(labels.select("key"), "key", "left_anti").withColumn(
        "hash", F.xxhash64("key", "text", F.lit(7))
    )
    chosen = hashed.filter(F.pmod("hash", F.lit(1_000_000)) < int(1_000_000 * share))
    return chosen.dropDuplicates(["hash"]).select("key", "text").limit(size)


def _marker_lists(sample: DataFrame) -> list[set[int]]:
    """Marker features of both halves of the sample, learned in one task."""

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, texts = np.zeros((2, 2, 1 << BITS)), np.zeros((2, 2), np.int64)
        for batch in batches:
            keys, toxic = values(batch, "key"), values(batch, "toxic")
            for key, bad, (_, _, distinct) in zip(keys, toxic, _texts(batch), strict=True):
                if bad is not None:
                    half, bad = xxhash.xxh64_intdigest(str(key)) & 1, int(bad)
                    seen[half, bad, list({n for w in distinct for n in _FEATURES[w]})] += 1
                    texts[half, bad] += 1
        for half in range(2):
            found = sorted(markers(seen[half], texts[half]))
            yield pa.RecordBatch.from_arrays(
                [pa.array([half] * len(found), pa.int32()), pa.array(found, pa.int64())],
                names=["half", "feature"],
            )

    found = sample.repartition(1).mapInArrow(learn, "half int, feature long").collect()
    return [{r["feature"] for r in found if r["half"] == half} for half in (0, 1)]


def _votes(rows: DataFrame, lists: list[set[int]]) -> DataFrame:
    """key and votes of every row with a word, before the given labels."""
    names = [name for name, _, _ in SHARES] + ["marked"]
    fields = "key long, " + ", ".join(f"{n} int" for n in names)

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marked = [m for m in map(_Marked, lists) if m.features]
        for batch in batches:
            keys, out = [], []
            for key, (text, words, distinct) in zip(values(batch, "key"), _texts(batch), strict=True):
                if words:
                    keys.append(key)
                    found = any(any(map(m.__getitem__, distinct)) for m in marked)
                    flag = NOTHING if not marked else BAD if found else GOOD
                    out.append([*votes(shares(text, words, distinct)), flag])
            columns = np.array(out, np.int32).reshape(-1, len(names)).T
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int64()), *[pa.array(c) for c in columns]], names=["key", *names]
            )

    return rows.mapInArrow(vote, fields)


class _Starts(dict):
    """What a measure says of the features of words' starts, by their first five bytes."""

    def __init__(self, measure: Callable[[int, int], object]):
        self.measure = measure

    def __missing__(self, start: bytes) -> object:
        if len(self) >= CACHE_WORDS:
            self.clear()
        value = self[start] = self.measure(_feature(b"4" + start[:4]), _feature(b"5" + start))
        return value


class _Marked(dict):
    """Whether a word has two marker features; one alone may be another word's with the same number."""

    def __init__(self, found: set[int]):
        self.features = found
        self.starts = _Starts(lambda four, five: (four in found) + (five in found))

    def __missing__(self, word: bytes) -> bool:
        if len(self) >= CACHE_WORDS:
            self.clear()
        # Most words' starts are no markers, and then the word itself need not be hashed.
        count = self.starts[word[:5]]
        value = self[word] = count == 2 or (count == 1 and _feature(b"w" + word) in self.features)
        return value


PROSE = [name for name, _, _ in SHARES] + ["quality"]
ABUSE = ["marked", "toxic"]


def _chances(voted: DataFrame, labellers: list[str], name: str) -> list[tuple]:
    """(votes..., chance) of every vote pattern that occurs."""
    counted = voted.groupBy(*labellers).agg(F.count("*").alias("n")).collect()
    if not counted:
        return []
    patterns = np.array([[r[c] for c in labellers] for r in counted], np.int64)
    chance = posteriors(patterns, np.array([r["n"] for r in counted], float))
    return [(*map(int, p), float(c)) for p, c in zip(patterns, chance, strict=True)]


def _scorers(sample: DataFrame) -> np.ndarray:
    """Weights (2, 2^BITS + 1) of the scorers for prose and abuse, trained in one task."""

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, targets = [], []
        for batch in batches:
            labels = zip(values(batch, "prose"), values(batch, "clean"), strict=True)
            for label, (text, words, distinct) in zip(labels, _texts(batch), strict=True):
                if words:
                    rows.append(features(distinct, shares(text, words, distinct)))
                    targets.append(label)
        for i in range(2):
            weights = np.zeros((1 << BITS) + 1)
            if rows:
                weights = train(rows, np.array([t[i] for t in targets], float))
            yield pa.RecordBatch.from_arrays(
                [pa.array([i], pa.int32()), pa.array([weights.astype("<f8").tobytes()], pa.binary())],
                names=["scorer", "weights"],
            )

    found = sample.repartition(1).mapInArrow(learn, "scorer int, weights binary").collect()
    return np.stack([np.frombuffer(r["weights"], "<f8") for r in sorted(found, key=lambda r: r["scorer"])])


def classify(
    documents: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text",
    sample: int = SAMPLE,
) -> DataFrame:
    """The columns of ``documents`` and prose, clean (chances) and accepted."""
    rows = documents.select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("text"))
    given = labels.select(
        F.col("doc_id").cast("long").alias("key"), F.col("quality").cast("int").alias("quality"),
        F.col("toxic").cast("int").alias("toxic"),
    ).filter("key is not null").groupBy("key").agg(
        F.min("quality").alias("quality"), F.max("toxic").alias("toxic")
    )
    chosen = stored(_sample(rows, given, sample), "quality-sample")
    lists = _marker_lists(chosen)

    labelled = given.select(
        "key", F.coalesce("quality", F.lit(NOTHING)).alias("quality"),
        F.coalesce(1 - F.col("toxic"), F.lit(NOTHING)).alias("toxic"),
    )

    def with_labels(votes_of: DataFrame) -> DataFrame:
        return votes_of.join(labelled, "key", "left").fillna(NOTHING, ["quality", "toxic"])

    voted = stored(with_labels(_votes(rows, lists)), "quality-votes")
    prose, clean = _chances(voted, PROSE, "prose"), _chances(voted, ABUSE, "clean")
    if not prose:
        return documents.select(
            "*", F.lit(None).cast("double").alias("prose"), F.lit(None).cast("double").alias("clean"),
            F.lit(False).alias("accepted"),
        )
    spark = documents.sparkSession
    # At most 3^5 and 3^2 rows.
    ints = lambda names: ", ".join(f"{n} int" for n in names)
    prose_of = F.broadcast(spark.createDataFrame(prose, f"{ints(PROSE)}, prose double"))
    clean_of = F.broadcast(spark.createDataFrame(clean, f"{ints(ABUSE)}, clean double"))
    unlabelled = voted.filter((F.col("quality") == NOTHING) & (F.col("toxic") == NOTHING)).count()
    pool = chosen.select(
        "text", F.coalesce("quality", F.lit(NOTHING)).alias("quality"),
        F.coalesce(1 - F.col("toxic"), F.lit(NOTHING)).alias("toxic"),
    ).unionByName(
        _others(rows, given, unlabelled, sample).select(
            "text", F.lit(NOTHING).alias("quality"), F.lit(NOTHING).alias("toxic")
        )
    )
    # Numbered, as rows without a label may share a key; written down, so that numbers stay.
    pool = stored(pool.withColumn("key", F.monotonically_increasing_id()), "quality-pool")
    targets = _votes(pool.select("key", "text"), lists).join(pool.select("key", "quality", "toxic"), "key")
    targets = targets.join(prose_of, PROSE).join(clean_of, ABUSE)
    training = pool.select("key", "text").join(targets.select("key", "prose", "clean"), "key")
    weights = spark.sparkContext.broadcast(_scorers(training.select("text", "prose", "clean")))
    return _scored(documents, text, weights)


class _Worth(dict):
    """A word's features that have a weight."""

    def __init__(self, weights: np.ndarray):
        live = self.live = weights.any(axis=0).tobytes()
        self.starts = _Starts(lambda *numbers: tuple(n for n in numbers if live[n]))

    def __missing__(self, word: bytes) -> tuple:
        if len(self) >= CACHE_WORDS:
            self.clear()
        whole = _feature(b"w" + word)
        value = self.starts[word[:5]]
        if self.live[whole]:
            value = (whole, *value)
        self[word] = value
        return value


def _scored(documents: DataFrame, text: str, weights) -> DataFrame:
    def score(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        table = weights.value
        worth = _Worth(table)
        for series in texts:
            out = np.full((len(series), 2), np.nan)
            for i, value in enumerate(series):
                encoded = value.encode() if value else b""
                words = encoded.lower().split()
                if not words:
                    continue
                distinct = set(words)
                # Most words have no weight: only the others' features are told apart.
                numbers = set().union(*filter(None, map(worth.__getitem__, distinct)))
                found = shares(encoded, words, distinct)
                numbers.update(_feature(b"s%d:%d" % (j, int(20 * s))) for j, s in enumerate(found) if s >= 0)
                raw = table[:, sorted(numbers)].sum(axis=1) + table[:, -1]
                out[i] = 1 / (1 + np.exp(-np.clip(raw, -35, 35)))
            frame = pd.DataFrame(out, columns=["prose", "clean"])
            yield frame.astype(object).where(frame.notna(), None)

    scored = F.pandas_udf(score, "prose double, clean double")
    return documents.withColumn("_scores", scored(F.col(text).cast("string"))).select(
        *[F.col(f"`{c}`") for c in documents.columns],
        F.col("_scores.prose").alias("prose"), F.col("_scores.clean").alias("clean"),
        F.coalesce((F.col("_scores.prose") >= 0.5) & (F.col("_scores.clean") >= 0.5), F.lit(False))
        .alias("accepted"),
    )
