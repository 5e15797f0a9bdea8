import random
import re

import numpy as np
import pandas as pd
import pytest
from stackroom.llm import jaccard_join, store


def brute(docs):
    sets = {}
    for key, text in docs:
        words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").lower())
        shingles = {tuple(words[i : i + 5]) for i in range(len(words) - 4)} or ({tuple(words)} if words else set())
        sets[key] = shingles
    parent = {k: k for k in sets}

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                low, high = sorted((root(a), root(b)))
                parent[high] = low
    return {k: (len(sets[k]), root(k)) for k in sets}


def test_like_brute_force(spark):
    rng = random.Random(3)
    docs = [(0, None), (1, ""), (2, "Two words"), (3, "two  WORDS"), (4, "\u00a0"), (5, "a b c d e"), (6, " ")]
    for group in range(12):
        words = [rng.choice("abcdefgh") + str(rng.randrange(60)) for _ in range(rng.choice([8, 30, 90]))]
        for _ in range(8):
            docs.append((len(docs), " ".join(words)))
            words = list(words)
            words[rng.randrange(len(words))] = f"new{rng.randrange(3)}"
    docs += [(len(docs) + i, "the same text again and again") for i in range(40)]
    frame = spark.createDataFrame([(k, t, 7) for k, t in docs], "doc_id long, text string, n_links int")
    found = jaccard_join.near_duplicates(frame).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found} == brute(docs)
    assert len(found) == len(docs)


def test_lists_give_the_same_rows_in_few_buckets_and_in_many():
    def group(entries):
        hashes, classes, sizes = zip(*entries, strict=True)
        return pd.DataFrame({
            "hashes": [np.array(hashes, np.uint32).tobytes()], "classes": [np.array(classes, np.int64).tobytes()],
            "sizes": [np.array(sizes, np.int32).tobytes()],
        })

    # Classes 1 and 2 share 30 lists; 3 is too large to link with 4; 5 to 12 share two lists.
    entries = [(h, c, 100) for h in range(30) for c in (1, 2)] + [(40, 3, 200), (40, 4, 100), (41, 1, 100)]
    entries += [(h, c, 100) for h in (50, 51) for c in range(5, 13)]
    one = jaccard_join._shown(group(entries), 75)
    many = pd.concat(
        [jaccard_join._shown(group([e for e in entries if e[0] == h]), 75) for h in sorted({e[0] for e in entries})]
    )
    assert sorted(map(tuple, one.to_numpy().tolist())) == sorted(map(tuple, many.to_numpy().tolist()))
    shown = one.groupby(["class", "head", "pair"]).size().to_dict()
    assert shown == {(2, 1, True): 30} | {(c, 5, False): 2 for c in range(5, 13)}


def test_pairs_whose_sizes_rule_out_a_link_are_not_handed_on(spark):
    words = [f"w{i}" for i in range(60)]
    docs = [(0, " ".join(words)), (1, " ".join(words[:10])), (2, " ".join([*words[:59], "other"]))]
    rows = spark.createDataFrame(docs, "key long, text string")
    levels = spark.sparkContext.broadcast(np.zeros(1 << jaccard_join.SKETCH_BITS, np.uint8))
    found = jaccard_join._heads(rows, levels, 5, 75, 8).collect()
    assert [(r["pair"], r["size"], r["head_size"]) for r in found] == [(True, 56, 56)] and found[0]["shared"] > 10


def test_empty_table(spark):
    assert jaccard_join.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def near_copies(rng, size, changed):
    """Copies of one text, many of which link with few others; a line that all hold; some other texts."""
    base = [f"base{i}" for i in range(90)]
    docs = []
    for key in range(size):
        words = list(base)
        for _ in range(rng.choice(changed)):
            words[rng.randrange(80)] = f"new{rng.randrange(10**6)}"
        docs.append((key, " ".join(words)))
    line = " ".join(base[80:])
    docs += [(size + i, " ".join(f"w{rng.randrange(10**6)}" for _ in range(i % 7)) + " " + line) for i in range(40)]
    return docs


@pytest.mark.parametrize(("held", "compared"), [(2_000_000, 4_000_000_000), (3_000, 10**12), (10**9, 100_000)])
def test_pieces_of_any_size_like_brute_force(spark, monkeypatch, held, compared):
    monkeypatch.setattr(jaccard_join, "HELD", held)
    monkeypatch.setattr(jaccard_join, "COMPARED", compared)
    docs = near_copies(random.Random(5), 150, [1, 2, 3, 4, 5])
    found = jaccard_join.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found} == brute(docs)


def test_rows_written_grow_no_faster_than_the_group(spark, monkeypatch):
    """Nothing grows with the number of lists that a group shares, or with its pairs."""
    written = []

    def counting(df, purpose, **options):
        out = store.stored(df, purpose, **options)
        written.append((out.count(), purpose))
        return out

    monkeypatch.setattr(jaccard_join, "stored", counting)
    docs = near_copies(random.Random(6), 300, [2, 3, 4, 5, 6])
    jaccard_join.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert max(written)[0] <= 8 * len(docs)


def test_links_connect_what_is_linked():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 1 << 63, 60, dtype=np.uint64)
    sets = [np.unique(np.r_[base[rng.random(60) < keep], rng.integers(0, 1 << 63, 3, dtype=np.uint64)])
            for keep in rng.choice([0.7, 0.85, 1.0], 200)]
    sets += [base[:k] for k in range(1, 61)]
    every = {
        (a, b) for a, x in enumerate(sets) for b, y in enumerate(sets)
        if a != b and 100 * len(np.intersect1d(x, y)) >= 75 * len(np.union1d(x, y))
    }

    def parts(links):
        own = list(range(len(sets)))
        for _ in sets:
            for a, b in links:
                own[a] = own[b] = min(own[a], own[b])
        return own

    links = jaccard_join.connected(sets, 75)
    assert set(links) <= every and len(links) < len(sets) and parts(links) == parts(every)
    tree = jaccard_join.PrefixTree(sets)
    for a, x in enumerate(sets):
        assert set(tree.search(x, 75).tolist()) - {a} == {b for c, b in every if c == a}
