"""From raw documents to packed training sequences.

Five stages, each of which works on all that the one before it kept:

1. quality classifier: documents that are not readable prose, or are abusive, go;
2. language: documents whose language cannot be told go, and those that are plainly in another one
   than the one they are filed under;
3. near duplicates: of each group of rows linked by word shingles one with the smallest doc_id stays;
4. decontamination: documents with a passage of the benchmark go;
5. packing: what is left, as pieces with their places in sequences.

All but the last return the columns of ``documents``.  Every stage's rows are written below
``spark.checkpoint.dir`` and read again.  Empty tables pass through; the operators' docstrings say
what happens to null and empty texts.  The third stage compares rows, whatever their doc_id: rows that
share one, or have none, go only if their texts link them; a row without a doc_id comes last in its group.
The fourth one judges every row by its own text.  Further columns may have any name, also that of a column that
an operator adds: stages work on renamed columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stackroom.llm import decontaminate, jaccard_join, language, quality
from stackroom.llm.queries import learned_from, packed_documents, prepare, table
from stackroom.llm.store import stored

#: Score at which another language than the stated one counts as plain.
PLAIN = 0.5


def _named_apart(docs: DataFrame) -> DataFrame:
    """``docs`` with names that no operator's own columns have."""
    return docs.toDF(*[f"document_{c}" for c in docs.columns])


def _as_before(rows: DataFrame, docs: DataFrame) -> DataFrame:
    return rows.select(*[F.col(f"`document_{c}`").alias(c) for c in docs.columns])


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    judged = quality.classify(
        _named_apart(docs), table(spark, sf_dir, "labels"), key="document_doc_id", text="document_text"
    )
    return _as_before(judged.filter("accepted"), docs)


def keep_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    rows, text, lang = _named_apart(docs), "document_text", "document_lang"
    learned = language.learn(rows, learned_from("document_doc_id"), "document_doc_id", text, lang)
    found = language.identify(rows, learned, text)
    other = F.coalesce(F.col("lang_pred") != F.col(lang), F.lit(False)) & (F.col("score") >= PLAIN)
    return _as_before(found.filter((F.col("lang_pred") != language.UNKNOWN) & ~other), docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    # Rows are numbered for this stage, and written down, so that numbers stay.  The hash of one number
    # is a bijection; it spreads the low bits, which the join tells documents apart by.
    rows = _named_apart(docs).withColumn("_row", F.xxhash64(F.monotonically_increasing_id()))
    numbered = stored(rows, "pipeline-rows")
    groups = jaccard_join.near_duplicates(
        numbered.select("_row", F.col("document_text").alias("text")), key="_row"
    )
    # Rows alone in their group stay; of the others the smallest id does, of equal ones the first row.
    doc_id = F.col("document_doc_id").alias("doc_id")
    ids = numbered.select("_row", doc_id).join(groups.select("_row", "component_id"), "_row")
    first = ids.groupBy("component_id").agg(
        F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "_row"))["_row"].alias("_row")
    )
    return _as_before(numbered.join(first, "_row", "left_semi"), docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return packed_documents(docs)


STAGES = [
    ("quality", keep_quality),
    ("language", keep_language),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("packing", pack),
]

#: None of these operators can be said in SQL; tests compare them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    sf_dir = sf_dir.rstrip("/")
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name.replace('_', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
