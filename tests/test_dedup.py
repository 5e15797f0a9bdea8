"""Which row counts does not depend on how rows are spread."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from stackroom.operators import dedup, entities, sources, tags
from stackroom.operators.covers import new_covers
from stackroom.operators.entities import for_target, union_datasets


def skewed_rows(seed, count=3000):
    """A third of all rows share one key, a third have none."""
    rng = random.Random(seed)
    rows = []
    for i in range(count):
        key = rng.choice(["hot", None, f"k{rng.randint(0, 300)}"])
        rows.append((f"f{rng.randint(0, 3)}", i, key, rng.random()))
    rng.shuffle(rows)
    return rows


SCHEMA = "source_file string, source_offset bigint, key string, value double"
PLACE = ["source_file", "source_offset"]


def brute_force_first(rows):
    first = {}
    kept = []
    for row in sorted(rows):
        if row[2] is None:
            kept.append(row)
        elif row[2] not in first:
            first[row[2]] = row
    return sorted(kept + list(first.values()))


@pytest.mark.parametrize("keep", [dedup.keep_first, dedup.keep_first_wide])
@pytest.mark.parametrize("parts", [1, 7])
def test_keep_first(spark, keep, parts):
    rows = skewed_rows(parts)
    df = spark.createDataFrame(rows, SCHEMA).repartition(parts)
    assert sorted(map(tuple, keep(df, ["key"], PLACE).collect())) == brute_force_first(rows)


def test_keep_first_wide_without_broadcast(spark):
    rows = skewed_rows(3)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = spark.createDataFrame(rows, SCHEMA)
        got = sorted(map(tuple, dedup.keep_first_wide(df, ["key"], PLACE).collect()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert got == brute_force_first(rows)


def test_keep_first_reduces_before_the_shuffle(spark):
    df = spark.createDataFrame(skewed_rows(1, 50), SCHEMA)
    plan = dedup.keep_first(df, ["key"], PLACE)._jdf.queryExecution().executedPlan().toString()
    below_shuffle = plan[plan.index("Exchange"):]
    assert "WindowGroupLimit" in below_shuffle and "Partial" in below_shuffle


def test_keep_first_collation(spark):
    rows = [(1, "Äb"), (2, "ab"), (3, "AB"), (4, "c")]
    df = spark.createDataFrame(rows, "n int, key string")
    plain = dedup.keep_first(df, ["key"], ["n"])
    folded = dedup.keep_first(df, ["key"], ["n"], collation="UNICODE_CI_AI")
    assert sorted(r.n for r in plain.collect()) == [1, 2, 3, 4]
    assert sorted(r.n for r in folded.collect()) == [1, 4]


def test_first_wins_backfill(spark):
    rows = [(7, 1, None, "t1", "x"), (7, 2, "B", "t2", "y"), (7, 3, "C", "t3", "z"), (8, 4, " ", "t4", "w")]
    df = spark.createDataFrame(rows, "ol_num int, pos int, name string, updated_at string, a string")
    for shuffled in (df, df.orderBy(F.desc("pos")).repartition(3)):
        got = dedup.first_wins_backfill(shuffled, ["ol_num"], ["pos"]).collect()
        assert sorted(map(tuple, got)) == [(7, 1, "B", "t2", "x"), (8, 4, " ", "t4", "w")]


def brute_force_backfill(rows):
    """Rows are (key, file, offset, name, touched, other)."""
    result = {}
    for key in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == key), key=lambda r: (r[1] is not None, r[1] or "", r[2]))
        named = [r for r in mine if (r[3] or "").strip()]
        first = list(mine[0])
        if named and not (first[3] or "").strip():
            first[3:5] = named[0][3:5]
        result[key] = tuple(first)
    return result


@pytest.mark.parametrize("broadcast", ["10m", "-1"])
def test_first_wins_over_files_like_brute_force(spark, broadcast):
    rng = random.Random(11)
    rows = []
    for n in range(600):
        # One key holds a third of the rows; some are NULL, some are alone; names are often blank.
        key = 7 if n % 3 == 0 else None if n % 17 == 0 else rng.randint(100, 400)
        rows.append((key, rng.choice(["a", "b", None, "é"]), n, rng.choice([None, "", " ", "N%d" % n]), "t%d" % n, n))
    schema = "key int, file string, at bigint, name string, updated_at string, other int"
    df = spark.createDataFrame(rows, schema).repartition(5)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        got = dedup.first_wins_backfill(df, ["key"], ["file", "at"]).collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert len(got) == len({r[0] for r in rows})
    assert {r.key: tuple(r) for r in got} == brute_force_backfill(rows)
    assert dedup.first_wins_backfill(df.limit(0), ["key"], ["file", "at"]).count() == 0


@pytest.mark.parametrize("name", ["first_wins_backfill", "work_entities", "author_entities", "merged_entities"])
def test_first_wins_holds_numbers_only(spark, sf_dir, name):
    from stackroom.queries import QUERIES

    plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan


def test_merge_entities(spark):
    schema = "kind string, ol_num int, name string, updated_at string, other string"
    old = spark.createDataFrame([("work", 1, " ", "a", "x"), ("work", 2, "B", "b", "x"), ("work", 3, None, "c", "x")], schema)
    new = spark.createDataFrame(
        [("work", 1, "N", "d", "y"), ("work", 2, "M", "e", "y"), ("work", 3, "", "f", "y"), ("author", 1, None, "g", "y")],
        schema,
    )
    assert sorted(map(tuple, entities.merge_entities(old, new).collect())) == [
        ("author", 1, None, "g", "y"), ("work", 1, "N", "d", "x"), ("work", 2, "B", "b", "x"), ("work", 3, None, "c", "x"),
    ]
    assert entities.merge_entities(old.limit(0), new).count() == 4


def brute_force_slugs(rows):
    """First of a base takes it; then base-number, base-number-2, ..."""
    seen, result = defaultdict(int), {}
    bases = set()
    for pos, base, number in sorted(rows):
        if base not in bases:
            bases.add(base)
            result[pos] = base
            seen[base, number] = 1
            continue
        step = seen[base, number] = max(seen[base, number], 1) + 1
        result[pos] = f"{base}-{number}" if step == 2 else f"{base}-{number}-{step - 1}"
    return result


def test_numbered_slugs(spark):
    rng = random.Random(5)
    rows = [(i, rng.choice(["untitled", "a", "b"]), rng.randint(1, 40)) for i in range(300)]
    df = spark.createDataFrame(rows, "pos int, base string, number int").repartition(5)
    got = dedup.numbered_slugs(df, "base", "number", ["pos"]).collect()
    assert {r.pos: r.slug for r in got} == brute_force_slugs(rows)


TAG_SCHEMA = (
    "kind string, ol_num bigint, dataset string, source_file string, source_offset bigint, "
    "created_at timestamp_ntz, updated_at timestamp_ntz, subjects array<string>"
)


def tag_rows(spark, rows):
    data = [("work", n, "d", "f", i, None, None, s) for i, (n, s) in enumerate(rows)]
    return tags.explode_tags(spark.createDataFrame(data, TAG_SCHEMA).repartition(3))


def test_tags_first_spelling_and_counts(spark):
    exploded = tag_rows(spark, [(1, ["Sci-Fi", "x", "!!"]), (2, ["sci fi"]), (2, ["SCI FI"]), (3, [])])
    dimension, links = tags.build_tags(exploded), tags.build_links(exploded)
    counted = tags.recount_tags(dimension, links)
    assert sorted((r.slug, r.name, r.items_count) for r in counted.collect()) == [
        ("sci-fi", "Sci-Fi", 2), ("x", "x", 1),
    ]
    assert sum(r.items_count for r in counted.collect()) == links.count()


def test_tags_and_links_of_first_mentions(spark):
    exploded = tag_rows(
        spark, [(1, ["B", "a"]), (1, ["b", "A", "c"]), (2, ["a", None]), (3, ["c", "C", "c "]), (1, ["B"]), (2, [])]
    )
    mentions = tags.first_mentions(exploded)
    assert sorted((r.entity_id, r.slug, r.subject, r.source_offset, r.ord) for r in mentions.collect()) == [
        (1, "a", "a", 0, 1), (1, "b", "B", 0, 0), (1, "c", "c", 1, 2), (2, "a", "a", 2, 0), (3, "c", "c", 3, 0),
    ]
    assert sorted(tags.build_tags(mentions).collect()) == sorted(tags.build_tags(exploded).collect())


def test_recount_with_deleted_links(spark):
    dimension = spark.createDataFrame([("work", 1, 9), ("work", 2, 9)], "kind string, tag_id bigint, items_count bigint")
    links = spark.createDataFrame(
        [("work", 5, 1, None), ("work", 6, 1, "2020-01-01")],
        "kind string, entity_id bigint, tag_id bigint, deleted_at string",
    )
    got = tags.recount_tags(dimension, links).collect()
    assert sorted((r.tag_id, r.items_count) for r in got) == [(1, 1), (2, 0)]


def test_links_to_known_tags_drops_unknown(spark):
    exploded = tag_rows(spark, [(1, ["a", "b", "A"])])
    known = tags.build_tags(exploded).filter("slug = 'a'")
    assert tags.links_to_known_tags(exploded, known).count() == 1


def test_sources_first_dates(spark):
    data = [
        ("work", 1, "d", "f", 2, "2020-01-02 00:00:00", [("ia", "x"), ("ia", "x")]),
        ("work", 2, "d", "f", 1, "2020-01-01 00:00:00", [("ia", "x")]),
    ]
    rows = spark.createDataFrame(
        data,
        "kind string, ol_num bigint, dataset string, source_file string, source_offset bigint, "
        "t string, source_records array<struct<source:string,source_key:string>>",
    ).withColumn("created_at", F.col("t").cast("timestamp_ntz")).withColumn("updated_at", F.col("created_at"))
    exploded = sources.explode_sources(rows)
    record = sources.build_source_records(exploded).collect()
    assert [(r.source, r.source_key, str(r.created_at)) for r in record] == [("ia", "x", "2020-01-01 00:00:00")]
    links = sources.build_source_links(exploded).collect()
    assert sorted((r.entity_type, r.entity_id) for r in links) == [("book", 1), ("book", 2)]


def test_late_cover_is_kept(spark):
    existing = spark.createDataFrame([(10,)], "cover_id bigint")
    incoming = spark.createDataFrame([(4,), (10,)], "cover_id bigint")
    assert [r.cover_id for r in new_covers(existing, incoming).collect()] == [4]


def test_union_and_target_columns(spark):
    a = spark.createDataFrame([(1, "x")], "n int, name string")
    b = spark.createDataFrame([(2,)], "n int")
    rows = union_datasets([("a", a), ("b", b)])
    assert sorted(map(tuple, rows.select("dataset", "n", "name").collect()), key=str) == [
        ("a", 1, "x"), ("b", 2, None),
    ]
    assert for_target(rows, ["n", "birth_date", "dataset"]).columns == ["n", "dataset"]


def test_a_hot_slug_is_joined_where_its_pairs_are(spark):
    from statistics import median

    slug = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), (F.col("id") % 4001).cast("string")))
    pairs = spark.range(24000).select(F.lit("work").alias("kind"), F.col("id").alias("entity_id"), slug.alias("slug"))
    known = pairs.select("kind", "slug").distinct().withColumn("tag_id", F.xxhash64("slug"))
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "8", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        links = tags.links_to_known_tags(pairs, known)
        assert links.distinct().count() == 24000
        for hot in (True, False):
            own = links.filter((F.col("tag_id") == known.filter("slug = 'hot'").first().tag_id) == F.lit(hot))
            sizes = [r["count"] for r in own.groupBy(F.spark_partition_id()).count().collect()]
            assert len(sizes) >= 4 and max(sizes) <= 2 * median(sizes)
        assert tags.links_to_known_tags(pairs.limit(0), known).count() == 0
        assert tags.links_to_known_tags(pairs, known.limit(0)).count() == 0
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


@pytest.mark.parametrize("few", [0, 50_000])
def test_first_rows_of_many_repeated_keys(spark, monkeypatch, few):
    monkeypatch.setattr(dedup, "FEW_KEYS", few)
    rng, rows = random.Random(5), []
    for n in range(500):
        key = 7 if n % 3 == 0 else None if n % 17 == 0 else rng.randint(100, 300)
        rows.append((key, rng.choice(["a", "b", None]), n, rng.choice([None, " ", "N%d" % n]), "t%d" % n, n))
    df = spark.createDataFrame(rows, "key int, file string, at bigint, name string, updated_at string, other int")
    df = df.repartition(5)
    got = dedup.first_wins_backfill(df, ["key"], ["file", "at"])
    assert {r.key: tuple(r) for r in got.collect()} == brute_force_backfill(rows)
    assert got.count() == len({r[0] for r in rows})
    kept = dedup.keep_first_wide(df, ["key"], ["at"])
    firsts = {k: min(r[2] for r in rows if r[0] == k) for k in {r[0] for r in rows}}
    assert sorted(r.at for r in kept.collect()) == sorted(r[2] for r in rows if r[0] is None or firsts[r[0]] == r[2])
    # Rows that come twice, place and all, stay twice either way, and none is supplied by its own copy.
    twice = spark.createDataFrame([(1, 1, "A", "t"), (1, 1, "A", "t"), (1, 2, "B", "u"), (2, 3, None, "v"), (2, 4, "C", "w")],
                                  "key int, at bigint, name string, updated_at string")
    assert sorted(map(tuple, dedup.first_wins_backfill(twice, ["key"], ["at"]).collect())) == [
        (1, 1, "A", "t"), (1, 1, "A", "t"), (2, 3, "C", "w"),
    ]
    assert sorted(r.at for r in dedup.keep_first_wide(twice, ["key"], ["at"]).collect()) == [1, 1, 3]
    # A row without a number comes last in its file.
    numberless = spark.createDataFrame([(1, "a", None, "A", "t"), (1, "a", 5, None, "u"), (1, "b", 1, "C", "w")],
                                       "key int, file string, at bigint, name string, updated_at string")
    assert list(map(tuple, dedup.first_wins_backfill(numberless, ["key"], ["file", "at"]).collect())) == [(1, "a", 5, "C", "w")]


def test_rows_of_many_repeated_keys_are_reduced_before_the_shuffle(spark, monkeypatch):
    monkeypatch.setattr(dedup, "FEW_KEYS", 0)
    df = spark.createDataFrame(skewed_rows(1, 50), SCHEMA)
    plan = dedup.keep_first_wide(df, ["key"], PLACE)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan
    below_shuffle = plan[plan.index("Exchange"):]
    assert "WindowGroupLimit" in below_shuffle and "Partial" in below_shuffle
