import numpy as np

from pyspark.sql import functions as F
from stackroom.llm import language as L


def brute(text, learned):
    count, at = 0, 0
    for a in range(0, len(text), L.STRETCH):
        stretch, at = text[a:a + L.STRETCH], 0
        while at < len(stretch):
            size = 0
            while at + size < len(stretch) and stretch[at:at + size + 1] in learned:
                size += 1
            at += max(1, size)
            count += 1
    return count


def test_phrases_like_brute_force():
    rng = np.random.default_rng(3)
    learned = {n: bytes(rng.choice(list(letters), 600).tolist()) for n, letters in (("a", b"abc "), ("b", b"bcde "))}
    texts = [bytes(rng.choice(list(b"abcdex "), int(n)).tolist()) for n in (0, 1, 5, 40, 3000, 2048, 2049)]
    found = L.Parser(learned).phrases(texts)
    assert found.tolist() == [[brute(t, learned["a"]), brute(t, learned["b"])] for t in texts]


def test_cases(spark):
    rows = spark.createDataFrame(
        [(1, "the cat and the dog", "en"), (2, "der hund und die katze", "de"), (3, None, "en"),
         (4, "", None), (5, "12 34 !!", "de"), (6, "the dog " * 5000, None), (6, "the dog", None), (None, "und die", None)],
        "doc_id long, text string, lang string",
    ).withColumn("score", F.lit("clash"))
    learned = L.learn(rows, F.lit(True))
    got = [(r["doc_id"], r["lang_pred"]) for r in L.identify(rows, learned).collect()]
    assert sorted(got, key=str) == sorted(
        [(1, "en"), (2, "de"), (3, "und"), (4, "und"), (5, "und"), (6, "en"), (6, "en"), (None, "de")], key=str
    )
    assert L.identify(rows.limit(0), learned).count() == 0
    assert {r["lang_pred"] for r in L.identify(rows, L.learn(rows, F.lit(False))).collect()} == {"und"}


def test_accuracy(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(3)) == 1
    found = L.identify(rows.filter(out), L.learn(rows, ~out))
    right = found.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right >= 0.95


def test_languages_nothing_was_learned_of():
    from stackroom.llm.language import Parser

    parser = Parser({"aa": b"", "bb": b"hello world and more", "cc": b" "})
    names, scores = parser.predict(["hello world", None, "123"])
    assert names == ["bb", "und", "und"] and all(0 <= s <= 1 for s in scores)
    assert Parser({"aa": b""}).predict(["hello"])[0] == ["und"]


def test_held_out_of_a_null_id(spark, tmp_path):
    from stackroom.llm.queries import QUERIES

    rows = [(None, "some plain words here", "en")] + [(i, "some plain words here", "en") for i in range(9)]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    got = QUERIES["op2_language_id"](spark, str(tmp_path)).collect()
    assert len(got) == 10 and all(isinstance(r.held_out, bool) and 0 <= r.score <= 1 for r in got)
    assert [r.held_out for r in got if r.doc_id is None] == [True]
