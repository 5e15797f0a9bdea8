"""Checksums of runs of words against zlib, and resampling against a plain version."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest

from stackroom.llm import importance
from stackroom.llm.importance import Features, draw, feature_buckets, resample
from stackroom.llm.running_crc import moved_on, run_checksums, scan

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def test_registers_against_zlib():
    rng = np.random.default_rng(3)
    data = rng.integers(0, 256, 70_000, np.uint8)
    places = np.sort(rng.integers(0, len(data) + 1, 200))
    begin = 0x12345678
    registers, last = scan(data, places, begin)
    assert last == zlib.crc32(data.tobytes(), begin ^ 0xFFFFFFFF) ^ 0xFFFFFFFF
    a, b = places[:-1], places[1:]
    want = [zlib.crc32(data[i:j].tobytes()) for i, j in zip(a, b, strict=True)]
    assert run_checksums(registers[:-1], registers[1:], a, b).tolist() == want
    # Far beyond a chunk, and by nothing at all.
    zeros = zlib.crc32(b"\0" * 70_000, 0) ^ 0xFFFFFFFF
    assert moved_on(np.array([0xFFFFFFFF, 5], np.uint32), np.array([70_000, 0])).tolist() == [zeros, 5]


def plain_buckets(text, features):
    words = WORD.findall(bytes(c + 32 if 65 <= c <= 90 else c for c in (text or b"")))
    found = [
        zlib.crc32(b" ".join(words[i : i + n])) % features.buckets
        for n in range(features.least, features.most + 1)
        for i in range(len(words) - n + 1)
    ]
    return len(words), found


@pytest.mark.parametrize("lot", [40, 1 << 20])
def test_buckets_against_zlib(lot, monkeypatch):
    monkeypatch.setattr(importance, "LOT", lot)
    random.seed(lot)
    parts = ["a", "B", "é", "漢", "7", " ", "  ", ".", "\n", "-_", "Zed", "q" * 100]
    for features in (Features(), Features(2, 3, 500), Features(1, 2, 100_000)):
        texts = [None, b"", b" .", *("".join(random.choices(parts, k=k)).encode() for k in (1, 3, 50, 400, 0, 9))]
        got = [(n, b.tolist()) for n, b in feature_buckets(texts, features)]
        assert got == [plain_buckets(t, features) for t in texts]


def plain_resample(rows, target, features, share, least, seed):
    have, want = [0] * features.buckets, [0] * features.buckets
    found = [(key, *plain_buckets(None if t is None else t.encode(), features)) for key, t in rows]
    for counts, lists in ((have, [f for *_, f in found]), (want, [plain_buckets(t.encode(), features)[1] for t in target])):
        for bucket in (b for f in lists for b in f):
            counts[bucket] += 1
    n = features.buckets
    gain = [math.floor(1000 * math.log((t + 1) * (sum(have) + n) / ((s + 1) * (sum(want) + n)))) for s, t in zip(have, want, strict=True)]
    out = []
    for key, words, f in found:
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        out.append([key, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), words])
    able = sorted((r for r in out if r[-1] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    drawn = len(able) * share[0] // share[1]
    ranks = [(*r[:4], i if i <= drawn else None) for i, r in enumerate(able, 1)]
    return sorted(ranks + [(*r[:4], None) for r in out if r[-1] < least], key=str)


def test_resample_against_plain(spark):
    random.seed(8)
    words = ["red", "Blue", "green", "naïve", "4", "x"]
    rows = [(i, " ".join(random.choices(words, k=random.choice([0, 2, 5, 30])))) for i in range(150)]
    # A hot key with one text and with many, no key, no text, a repeated row.
    rows += [(7, "red red red red red red")] * 60 + [(None, "blue blue blue blue blue x"), (200, None), (201, ""), rows[4]]
    target = ["Red red naïve", "naïve 4"]
    schema = "doc_id bigint, text string, weight string, score string, rank string, _salt string, buckets string"
    docs = spark.createDataFrame([(*r, "w", "s", "r", "a", "b") for r in rows], schema).repartition(3)
    wanted = spark.createDataFrame([(t,) for t in target], "text string")
    features, share = Features(1, 2, 64), (30, 100)
    found = resample(docs, wanted, features=features, share=share, min_words=3)
    got = sorted((tuple(r) for r in found.collect()), key=str)
    assert found.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    plain = plain_resample(rows, target, features, share, 3, 2024)
    # Equal rows share a stretch of ranks in either version; which one has which is no matter.
    assert got == plain
    kept = draw(docs, found)
    assert set(kept.columns) == set(docs.columns)
    assert {r.doc_id for r in kept.collect()} == {r[0] for r in plain if r[4] is not None}


def test_empty_corpus_and_target(spark):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id bigint, text string")
    empty = docs.limit(0)
    assert resample(empty, docs, min_words=1).collect() == []
    (row,) = resample(docs, empty, min_words=1, share=(1, 1)).collect()
    assert row.rank == 1 and row.n_features == 3
