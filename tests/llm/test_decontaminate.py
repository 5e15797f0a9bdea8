import itertools

import numpy as np
import pytest

from stackroom.llm import decontaminate as D

WORDS = [f"w{i}" for i in range(400)]


def _offsets(mask):
    return [i for i, c in enumerate(mask) if c == "1"]


def test_masks_hit_every_window():
    masks = [_offsets(m) for m in D.MASKS]
    for gone in itertools.combinations(range(D.WINDOW), D.SUBSTITUTIONS):
        assert any(
            not any(start + o in gone for o in mask)
            for mask in masks for start in range(D.WINDOW - mask[-1])
        )


def brute(doc, items):
    found = set()
    for number, item in items:
        width = min(D.WINDOW, len(item))
        if len(item) < D.LEAST:
            continue
        enough = width - D.SUBSTITUTIONS * width // D.WINDOW
        for a in range(len(doc) - width + 1):
            for b in range(len(item) - width + 1):
                if sum(x == y for x, y in zip(doc[a:a + width], item[b:b + width])) >= enough:
                    found.add(number)
    return found


def test_like_brute_force(spark):
    rng = np.random.default_rng(5)
    draw = lambda n: [WORDS[i] for i in rng.integers(0, len(WORDS), n)]
    items = [(i, draw(int(n))) for i, n in enumerate(rng.integers(13, 40, 20))]
    docs = []
    for k in range(60):
        doc = draw(int(rng.integers(0, 80)))
        if k % 2:
            passage = list(items[k % 20][1])
            for at in rng.integers(0, len(passage), k % 9):
                passage[at] = "other"
            doc = doc[:20] + passage + doc[20:]
        docs.append((k, " ".join(doc)))
    bench = spark.createDataFrame([(i, " ".join(t), "x") for i, t in items], "item_id long, text string, lang string")
    rows = spark.createDataFrame(docs, "doc_id long, text string")
    got = {}
    for r in D.overlaps(rows, bench).collect():
        got.setdefault(r["key"], set()).add(r["item"])
    assert got == {k: f for k, t in docs if (f := brute(t.split(), items))}
    marked = {r["doc_id"]: r["contaminated"] for r in D.marked(rows, bench).collect()}
    assert marked == {k: k in got for k, _ in docs}
    assert {r["doc_id"] for r in D.clean(rows, bench).collect()} == set(marked) - set(got)


@pytest.mark.parametrize("bench", [[], [(None, None), (1, None), (2, ""), (3, "a b c")]])
def test_nothing_to_look_for(spark, bench):
    rows = spark.createDataFrame([(1, "a b c d e f g h i"), (2, None), (3, ""), (3, "")], "doc_id long, text string")
    items = spark.createDataFrame(bench, "item_id long, text string")
    assert D.clean(rows, items).count() == 4
    assert D.clean(rows.limit(0), items).count() == 0


@pytest.mark.parametrize("width", range(D.LEAST, D.WINDOW))
def test_masks_hit_short_items(width):
    masks = [_offsets(m) for m in (*D.MASKS, D.SHORT_MASK)]
    for gone in itertools.combinations(range(width), D.SUBSTITUTIONS * width // D.WINDOW):
        assert any(
            not any(start + o in gone for o in mask)
            for mask in masks for start in range(width - mask[-1])
        )


ITEM = " ".join(f"i{n}" for n in range(15))


def test_rows_are_judged_by_their_own_text(spark):
    rows = [(None, ITEM), (None, "clean one"), (7, f"x {ITEM} y"), (7, "clean two"), (7, "clean two"), (8, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    items = spark.createDataFrame([(None, ITEM), (None, ITEM), (4, "z " + ITEM)], "item_id long, text string")
    kept = sorted(map(tuple, D.clean(docs, items).collect()), key=repr)
    assert kept == sorted([r for r in rows if ITEM not in (r[1] or "")], key=repr)
    marked = sorted((r.doc_id, r.contaminated, r.n_items, r.item_id, r.tokens) for r in D.marked(docs, items)
                    .filter("doc_id is not null").collect() if r.contaminated)
    assert marked == [(7, True, 2, 4, 16)]  # the item of 16 tokens agrees in all but its first


@pytest.mark.parametrize("tokens", [10, 500_000])
def test_blocks_clashing_names_and_long_texts(spark, monkeypatch, tokens):
    """Whatever the number of blocks, also where all items share an id."""
    monkeypatch.setattr(D, "BLOCK_TOKENS", tokens)
    items = [(1, " ".join(f"b{k}x{n}" for n in range(14))) for k in range(6)]
    long = "word " * 400_000
    rows = [(k, f"{long if k == 2 else 'a b'} {text} c", 0.5, "s") for k, (_, text) in enumerate(items)]
    rows += [(9, long, 1.0, "t"), (10, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _bad double, `key.item` string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = D.clean(docs, bench)
    assert got.columns == docs.columns
    assert sorted(map(tuple, got.collect())) == sorted(rows[-2:])
    assert [r.n_items for r in D.marked(docs, bench).orderBy("doc_id").collect()] == [1] * 6 + [0, 0]


def test_capitals_and_repeated_rows(spark):
    text = "éa be ce de ee ef ge ha ie ja"
    rows = spark.createDataFrame([(1, f"X {text.upper()}!! y"), (1, f"x {text}"), (None, text)], "doc_id long, text string")
    items = spark.createDataFrame([(9, text)], "item_id long, text string")
    assert D.clean(rows, items).count() == 0
