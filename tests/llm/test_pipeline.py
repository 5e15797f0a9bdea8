import corpus_pipeline as P
from pyspark.sql import functions as F


def test_stages_keep_columns_and_clean_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in P.STAGES[:-1]:
        kept = stage(spark, docs, sf_dir)
        assert kept.columns == docs.columns
        assert 0 < kept.count() <= docs.count()
        assert kept.select("doc_id", "text").subtract(docs.select("doc_id", "text")).count() == 0
    packed = P.run(spark, sf_dir)
    used = packed.groupBy("sequence_id").agg(F.sum("length").alias("n"), F.max(F.col("offset") + F.col("length")).alias("m"))
    assert used.filter("n > 2048 or n <> m").count() == 0


def test_empty_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(0)
    for _, stage in P.STAGES:
        assert stage(spark, docs, sf_dir).count() == 0


def test_rows_that_share_an_id_or_have_none_are_compared(spark, sf_dir):
    words = [[f"w{i}x{j}" for j in range(20)] for i in range(5)]
    texts = [" ".join(w) for w in words]
    rows = [(5, texts[0]), (5, texts[1]), (5, texts[1]), (None, texts[2]), (None, texts[3]), (None, texts[0]),
            (9, texts[3]), (4, texts[4] + " more"), (3, texts[4]), (None, None), (6, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    kept = [tuple(r) for r in P.drop_near_duplicates(spark, docs, sf_dir).collect()]
    wanted = [(5, texts[0]), (5, texts[1]), (None, texts[2]), (9, texts[3]), (3, texts[4]), (None, None), (6, "")]
    assert sorted(kept, key=repr) == sorted(wanted, key=repr)


def test_columns_of_any_name_and_shared_ids(spark, sf_dir):
    """What stages decide does not depend on further columns, and these come through unchanged."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").withColumn(
        "doc_id", F.when(F.col("doc_id") % 10 > 0, F.col("doc_id") - F.col("doc_id") % 2)
    )
    clashing = ["accepted", "prose", "clean", "score", "lang_pred", "_bad", "_row", "_text", "_scores", "_found", "key"]
    more = docs.select("*", *[F.concat(F.lit(name), F.md5("text")).alias(name) for name in clashing])
    for _, stage in P.STAGES[:-1]:
        plain, kept = stage(spark, docs, sf_dir), stage(spark, more, sf_dir)
        assert kept.columns == more.columns
        assert sorted(map(tuple, kept.select(*docs.columns).collect()), key=repr) == sorted(
            map(tuple, plain.collect()), key=repr
        )
        changed = F.lit(False)
        for name in clashing:
            changed = changed | ~F.col(name).eqNullSafe(F.concat(F.lit(name), F.md5("text")))
        assert kept.filter(changed).count() == 0


def test_contaminated_rows_go_alone(spark, sf_dir):
    item = spark.read.parquet(f"{sf_dir}/benchmark.parquet").first()["text"]
    rows = [(None, item), (None, "this one is clean"), (7, f"before {item} after"), (7, "so is this"), (8, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = sorted(map(tuple, P.drop_contaminated(spark, docs, sf_dir).collect()), key=repr)
    assert kept == sorted([rows[1], rows[3], rows[4]], key=repr)
