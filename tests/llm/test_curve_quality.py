import numpy as np
from pyspark.sql import functions as F

from stackroom.llm import curve_search, quality


def test_nearest_like_brute_force(spark):
    rng = np.random.default_rng(5)
    vectors = rng.normal(0, 1, (300, 8))
    vectors[100:140] = vectors[0]
    rows = [(i, v.tolist(), 0.5) for i, v in enumerate(vectors)]
    nan, inf = float("nan"), float("inf")
    rows += [(900, None, 1.0), (920, [0.0] * 8, 1.0), (940, [nan] * 8, 1.0), (960, [inf] * 8, 1.0),
             (980, [None] * 8, 1.0)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score double")
    found = curve_search.neighbours(frame, F.col("vec_id") % 20 == 0).collect()
    hits = 0
    for query in range(0, 300, 20):
        own = sorted((r for r in found if r["query_id"] == query), key=lambda r: r["rank"])
        assert [r["rank"] for r in own] == list(range(1, 21))
        assert [(-r["score"], r["vec_id"]) for r in own] == sorted((-r["score"], r["vec_id"]) for r in own)
        scores = vectors @ vectors[query]
        assert all(abs(scores[r["vec_id"]] - r["score"]) < 1e-12 and r["vec_id"] != query for r in own)
        wanted = sorted((i for i in range(300) if i != query), key=lambda i: (-scores[i], i))[:20]
        hits += len({r["vec_id"] for r in own} & set(wanted))
    assert len(found) == 15 * 20 and hits >= 0.9 * 15 * 20


def test_quality_edge_cases(spark):
    # sf0.001 has 87 labels, too few to learn from: 78 of its decisions agree with them.
    sf_dir = "/root/testdata/sf0.01"
    given = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    more = spark.createDataFrame([(-1, None), (-2, ""), (-3, "\x20\n"), (-4, "!" * 300_000)], "doc_id long, text string")
    docs = given.unionByName(more).withColumn("accepted_by", F.lit("x"))
    out = {r["doc_id"]: r for r in quality.classify(docs, labels).select("doc_id", "accepted").collect()}
    assert len(out) == docs.count()
    assert not any(out[k]["accepted"] for k in (-1, -2, -3))
    assert out[-4]["accepted"] is not None
    held = labels.collect()
    right = sum(out[r["doc_id"]]["accepted"] == (r["quality"] == 1 and r["toxic"] == 0) for r in held if r["doc_id"] in out)
    assert right >= 0.9 * sum(r["doc_id"] in out for r in held)


def test_given_labels_are_estimated_like_other_votes():
    good, bad, nothing = quality.GOOD, quality.BAD, quality.NOTHING
    patterns = [[v, v, v, v, given] for v in (good, bad) for given in (good, bad, nothing)]
    chance = quality.posteriors(np.array(patterns), np.array([80.0, 20, 900, 20, 80, 900]))
    assert min(chance[:3]) > 0.9 and max(chance[3:]) < 0.1


def test_unlabelled_documents_teach(spark):
    rng = np.random.default_rng(3)
    names = [f"word{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(400)]
    clean = [(i, " ".join(rng.choice(names, 30, replace=False))) for i in range(300)]
    # Junk that no label speaks of, under keys that are null or shared.
    junk = [(None if i % 2 else 900, f"$$%# @@{i} &&*! ~~^ BUY{i} NOW" * 3) for i in range(100)]
    docs = spark.createDataFrame(clean + junk, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(0, 300, 2)], "doc_id long, quality int, toxic int")
    out = quality.classify(docs, labels).collect()
    assert len(out) == 400
    assert all(r["accepted"] == r["text"].startswith("word") for r in out)


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert quality.classify(none, labels).count() == 0
    vectors = spark.createDataFrame([], "vec_id long, embedding array<double>")
    assert curve_search.neighbours(vectors, F.col("vec_id") % 20 == 0).count() == 0


def test_words_are_judged_without_keeping_their_features():
    rng = np.random.default_rng(1)
    words = [b"w%d" % i for i in range(500)] + [b"longer%d" % (i % 9) + b"x" * i for i in range(200)] + [b"\xc3\xa9", b"a"]
    numbers = {w: [quality._feature(b"w" + w), quality._feature(b"4" + w[:4]), quality._feature(b"5" + w[:5])] for w in words}
    weights = np.zeros((2, (1 << quality.BITS) + 1))
    found = {n for own in numbers.values() for n in own if rng.random() < 0.6}
    weights[1, list(found)] = 0.5
    quality._FEATURES.clear()
    worth, marked = quality._Worth(weights), quality._Marked(found)
    for word, own in numbers.items():
        assert set(worth[word]) == found.intersection(own)
        assert marked[word] == (sum(n in found for n in own) >= 2)
    assert not quality._FEATURES


def test_marker_lists_count_texts():
    seen, texts = np.zeros((2, 1 << quality.BITS)), np.array([900, 100])
    seen[1, 5], seen[:, 6], seen[1, 7], seen[:, 8] = 40, (900, 100), 7, (1, 60)
    assert quality.markers(seen, texts) == {5, 8}
    assert quality.markers(0 * seen, 0 * texts) == set()
    # What training holds of a document is four bytes for each feature.
    assert quality.features({b"some", b"words"}, (0.1, 0.2, 0.3, -1.0)).dtype == np.int32
