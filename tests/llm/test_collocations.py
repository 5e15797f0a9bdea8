"""Phrases by dynamic itemset counting against counting everything."""

import random
import re
from collections import Counter

import pytest

from stackroom.llm import collocations
from stackroom.llm.collocations import Settings, frequent_phrases, scored

SCHEMA = "lang string, text string, key string, n int, length int, shard int"


def brute(rows, least, most, kept):
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    counts, totals = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(lower)):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for n in range(1, most + 1):
                for i in range(len(words) - n + 1):
                    counts[lang, tuple(words[i : i + n])] += 1
    found = {k: c for k, c in counts.items() if c >= least}
    out = {}
    for (lang, words), a in found.items():
        if len(words) < 2:
            continue
        score, _, l, r = min(
            (2000000 * a // (found[lang, words[:k]] + found[lang, words[k:]]), k, found[lang, words[:k]], found[lang, words[k:]])
            for k in range(1, len(words))
        )
        hidden = any(
            other == lang and len(longer) > len(words) and 100 * f >= 80 * a
            and any(longer[i : i + len(words)] == words for i in range(len(longer) - len(words) + 1))
            for (other, longer), f in found.items()
        )
        if not hidden:
            out.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), l, r))
    return {
        (lang, rank, phrase.decode(), -a, l, r, totals[lang], -score)
        for lang, all_ in out.items()
        for rank, (score, a, phrase, l, r) in enumerate(sorted(all_)[:kept], 1)
    }


def made_rows(seed):
    random.seed(seed)
    words = ["The", "the", "über", "x y", "b", "c-d", "漢字", "e\\f", "en", "es"]
    gaps = [" ", " ", " ", "  ", "\t", ", ", ".\n", "\r", "; "]
    rows = [(None, None), ("en", ""), ("en", " ,. \n"), ("", "the b the b the b")]
    for _ in range(60):
        text = "".join(random.choice(words[: random.choice([3, 10])]) + random.choice(gaps) for _ in range(random.choice([1, 5, 60])))
        rows += [(random.choice(["en", "es", None, "und"]), text)] * random.choice([1, 1, 3])
    return rows


@pytest.mark.parametrize(("seed", "settings", "parts"), [
    (1, Settings(most=4, least=3, shards=2, filter_bits=20), 20),  # more than one slice
    (2, Settings(most=3, least=5, shards=3, filter_bits=9), 3),  # a filter that lets almost all pass
])
def test_equals_counting_everything(spark, seed, settings, parts, monkeypatch):
    monkeypatch.setattr(collocations, "LOT", 300)
    rows = made_rows(seed)
    docs = spark.createDataFrame([(*row, "clash", 1, 2, 3) for row in rows], SCHEMA).repartition(parts)
    got = scored(frequent_phrases(docs, settings), 7).collect()
    assert {tuple(r) for r in got} == brute(rows, settings.least, settings.most, 7) and len(got) > 20
    assert got[0].asDict().keys() == {"lang", "rank", "phrase", "a", "l", "r", "n", "score"}


def test_every_row_is_in_one_of_the_slices(spark):
    docs = spark.range(2000, numPartitions=40).selectExpr("'en' AS lang", "CAST(id AS string) AS text")
    folder, slices = collocations._write_shards(docs, "text", "lang", 2)
    counts = collocations._read_shards(spark, folder).groupBy("slice").count().collect()
    sizes = {r["slice"]: r["count"] for r in counts}
    assert sorted(sizes, key=str) == list(range(slices)) and sum(sizes.values()) == 2000
    assert sizes[slices - 1] > 800  # the last one is as large as all before


def test_what_ends_below_the_threshold_is_not_written(spark, monkeypatch):
    remove, written = collocations.remove_scratch, []

    def removed(folder):
        if "phrase-counts" in folder:
            written.append(spark.read.parquet(folder).collect())
        remove(folder)

    monkeypatch.setattr(collocations, "remove_scratch", removed)
    rows = [("en", f"a b c rare{i}") for i in range(40)]
    docs = spark.createDataFrame(rows, "lang string, text string")
    frequent = frequent_phrases(docs, Settings(shards=2)).filter("length > 0").collect()
    assert len(frequent) == 6 and all(r["n"] == 40 for r in frequent)
    assert any(r["n"] < 30 for r in written[0])
    for step, counts in enumerate(written):  # a round is two steps
        assert all(r["n"] >= 30 or r["since"] + 2 > step + 1 for r in counts)


def test_empty_tables_and_long_texts(spark):
    settings = Settings(least=2, shards=2, filter_bits=12)
    empty = spark.createDataFrame([], SCHEMA)
    assert scored(frequent_phrases(empty, settings)).collect() == []
    rare = spark.createDataFrame([("en", "one two three")], "lang string, text string")
    assert scored(frequent_phrases(rare, settings)).collect() == []
    text = "w" * 3_000_000 + " then " + "a b c. " * 200_000
    rows = [("en", text)]
    found = scored(frequent_phrases(spark.createDataFrame(rows, "lang string, text string"), settings)).collect()
    assert [(r.phrase, r.a, r.n) for r in found] == [("a b c", 200_000, 600_002)]


def test_products_beyond_64_bits(spark):
    big = 9 * 10**18
    rows = [("en", "a b", 2, big), ("en", "a", 1, big), ("en", "b", 1, 10**6), ("en", None, 0, big)]
    frequent = spark.createDataFrame(rows, "lang string, phrase string, length int, n bigint")
    (row,) = scored(frequent).collect()
    assert row.score == 2000000 * big // (big + 10**6) == 1999999
