"""Files to staging to catalog: replays, appends, rebuilds, increments."""

import json
import re

import pytest
from pyspark.sql import functions as F

from stackroom.functions import json as functions_json
from stackroom.operators.entities import rows_of_kind
from stackroom.plans import catalog, staging
from stackroom.sources.files import dump_files
from stackroom.streaming.ingest import catalog_stream, stage_stream

WORKS = "ol_dump_works_latest"


def record(kind, number, **fields):
    letter = {"work": "W", "edition": "M", "author": "A"}[kind]
    key = f"/{kind}s/OL{number}{letter}"
    body = {"type": {"key": f"/type/{kind}"}, "key": key, **fields}
    return f"/type/{kind}\t{key}\t1\t2020-01-01T00:00:00\t{json.dumps(body, ensure_ascii=False)}"


def stamp(day):
    return {"type": "/type/datetime", "value": f"{day}T01:02:03.5"}


@pytest.fixture
def folder(tmp_path):
    folder = tmp_path / "dumps"
    folder.mkdir()
    works = [
        record("work", 1, subjects=["Sci-Fi", "Война"], covers=[5], source_records=["ia:x"], created=stamp("2020-01-01")),
        record("work", 2, title="Two", subjects=["sci fi"]),
        record("work", 1, title="again, dropped by its key"),
        "no json here",
        record("work", 0, title="zero"),
        'x\t{"no":"key"}',
        'x\t{"no":"key"}',
    ]
    (folder / f"{WORKS}.txt").write_text("\n".join(works) + "\n", encoding="utf-8")
    editions = [record("edition", 1, title={"value": "Ed"}, source_records=["ia:x", "marc"])]
    (folder / "ol_dump_editions_latest.txt").write_text("\n".join(editions), encoding="utf-8")
    authors = [record("author", 7, personal_name="Mark", last_name="Twain", birth_date="May 1835", photos=[3, -1])]
    (folder / "ol_dump_authors_latest.txt").write_text("\n".join(authors), encoding="utf-8")
    (folder / "ol_dump_covers_metadata_latest.txt").write_text("5\t10\t20\t2011-05-06\n5\t1\t1\t2012-01-01\n0\t1\t1\t\nx\n")
    (folder / "ol_dump_ratings_latest.txt").write_text('/works/OL1W\t"a ""b"""\t5\n/works/OL2W\t\\N\n')
    (folder / "ol_dump_wikidata_latest.txt").write_text('Q1\t"{""id"":""Q1""}"\nQ2\tnope\n')
    return folder


def staged(spark, root, dataset=WORKS, kind="json", columns=0):
    rows = staging.read_staged(spark, root, dataset, kind, columns)
    return rows.drop("data").orderBy("source_file", "source_offset").collect()


def test_stage_folder(spark, folder, tmp_path):
    root = str(tmp_path / "root")
    datasets = staging.stage_folder(spark, str(folder), root, hold_partial_line=False)
    assert datasets[WORKS] == "json" and datasets["ol_dump_ratings_latest"] == "tsv"
    works = staged(spark, root)
    # Two rows without a key are both kept, the repeated key is not.
    assert [r.ol_key for r in works] == ["/works/OL1W", "/works/OL2W", "/works/OL0W", None, None]
    rejects = spark.read.parquet(f"{root}/rejects/{WORKS}").collect()
    assert [r.reject_reason for r in rejects] == ["no_json"]
    ratings = staged(spark, root, "ol_dump_ratings_latest", "tsv", 3)
    assert [(r.c1, r.c2, r.c3) for r in ratings] == [("/works/OL1W", 'a "b"', "5")]
    assert [r.wd_id for r in staged(spark, root, "ol_dump_wikidata_latest", "wikidata")] == ["Q1"]
    assert [(r.cover_id, r.width) for r in staged(spark, root, "ol_dump_covers_metadata_latest", "covers")] == [(5, 10), (0, 1)]


def files_of(spark, folder, dataset=WORKS):
    return [f for f in dump_files(spark, str(folder)) if f.dataset == dataset]


def test_resume_append_and_replay(spark, folder, tmp_path):
    root = str(tmp_path / "root")
    metrics = staging.stage_dataset(spark, files_of(spark, folder), root)
    assert tuple(metrics.drop("source_file").first()) == (7, 6, 1, 0)
    before = staged(spark, root)
    assert staging.stage_dataset(spark, files_of(spark, folder), root) is None

    path = folder / f"{WORKS}.txt"
    end = path.stat().st_size
    with path.open("a", encoding="utf-8") as out:
        out.write(record("work", 2, title="known key") + "\n" + record("work", 3, title="new") + "\n")
    metrics = staging.stage_dataset(spark, files_of(spark, folder), root)
    assert metrics.first().total == 2
    after = staged(spark, root)
    assert len(after) == len(before) + 1
    assert [r.ol_key for r in after if r.source_offset >= end] == ["/works/OL3W"]


def test_crash_between_rows_and_state(spark, folder, tmp_path):
    root = str(tmp_path / "root")
    files = files_of(spark, folder)
    staging.stage_dataset(spark, files, root)
    expected = staged(spark, root)
    # Lose the state: the next run has the same batch number and replaces the rows.
    spark.createDataFrame([], "batch int, none int").write.mode("overwrite").partitionBy("batch").parquet(f"{root}/state/{WORKS}")
    staging.stage_dataset(spark, files, root)
    assert staged(spark, root) == expected


def test_wikidata_is_rebuilt_when_columns_do_not_fit(spark, folder, tmp_path):
    root, dataset = str(tmp_path / "root"), "ol_dump_wikidata_latest"
    path = f"{root}/staging/{dataset}"
    spark.range(3).write.parquet(f"{path}/writer=plan/batch=0")
    files = files_of(spark, folder, dataset)
    done = [(files[0].path, files[0].size)]
    staging.write_batch(spark.createDataFrame(done, "source_file string, byte_offset bigint"), f"{root}/state/{dataset}", 0)
    staging.stage_dataset(spark, files, root)
    assert [r.wd_id for r in staged(spark, root, dataset, "wikidata")] == ["Q1"]
    bad = f"{root}/staging/{WORKS}"
    spark.range(3).write.parquet(f"{bad}/writer=plan/batch=0")
    with pytest.raises(ValueError):
        staging.stage_dataset(spark, files_of(spark, folder), root)


def test_reimport(spark, folder, tmp_path):
    root = str(tmp_path / "root")
    files = files_of(spark, folder)
    staging.stage_dataset(spark, files, root)
    expected = staged(spark, root)
    staging.reimport(spark, root, WORKS)
    assert staged(spark, root) == []
    staging.stage_dataset(spark, files, root)
    assert staged(spark, root) == expected


def test_catalog(spark, folder, tmp_path):
    root, out = str(tmp_path / "root"), str(tmp_path / "catalog")
    datasets = staging.stage_folder(spark, str(folder), root, hold_partial_line=False)
    assert catalog.classify_datasets(spark, root, datasets) == {
        WORKS: "work", "ol_dump_editions_latest": "edition", "ol_dump_authors_latest": "author",
    }
    assert catalog.discover_datasets(spark, root) == {
        name: kind for name, kind in datasets.items() if kind in ("json", "covers")
    }
    catalog.build_catalog(spark, root, out, options=catalog.Options(site_id=4))
    rows = catalog.read_entities(spark, out).orderBy("kind", "ol_num").collect()
    got = [(r.kind, r.ol_num, r.name, r.genres, r.screenshots, r.birth_date, r.site_id) for r in rows]
    assert got == [
        ("author", 7, "Mark Twain", [], [3, -1], "1835-01-01", 4),
        ("edition", 1, "Ed", [], [], None, 4),
        ("work", 1, None, ["Sci-Fi", "Война"], [5], None, 4),
        ("work", 2, "Two", ["sci fi"], [], None, 4),
    ]
    assert str([r for r in rows if r.ol_num == 1 and r.kind == "work"][0].updated_at) == "2020-01-01 01:02:03"
    authors = rows_of_kind(catalog.read_catalog(spark, out, "translations"), "author")
    assert [(r.author_id, r.name) for r in authors.collect()] == [(7, "Mark Twain")]
    with pytest.raises(ValueError):
        rows_of_kind(authors, "list")
    slugs = {(r.kind, r.slug) for r in catalog.read_catalog(spark, out, "translations").collect()}
    assert slugs == {("author", "mark-twain-7"), ("edition", "ed-1"), ("work", "1-1"), ("work", "two-2")}
    counts = {(r.slug, r.name, r.items_count) for r in catalog.tags_with_counts(spark, out).collect()}
    assert counts == {("sci-fi", "Sci-Fi", 2), ("voina", "Война", 1)}
    records = catalog.read_catalog(spark, out, "source_records")
    assert {(r.source, r.source_key) for r in records.collect()} == {("ia", "x"), ("unknown", "marc")}
    links = catalog.read_catalog(spark, out, "source_links").collect()
    assert sorted((r.entity_type, r.entity_id) for r in links) == [("book", 1), ("edition", 1), ("edition", 1)]
    assert [(r.cover_id, r.width) for r in catalog.read_catalog(spark, out, "covers").collect()] == [(5, 10)]


def test_all_records_decide_the_kind(spark, tmp_path):
    folder, root = tmp_path / "dumps", str(tmp_path / "root")
    folder.mkdir()
    lines = [record("edition", n) for n in range(1000)] + [record("work", n) for n in range(1100)]
    (folder / f"{WORKS}.txt").write_text("\n".join(lines) + "\n", encoding="utf-8")
    datasets = staging.stage_folder(spark, str(folder), root, hold_partial_line=False)
    assert catalog.classify_datasets(spark, root, datasets) == {WORKS: "work"}


def test_scratch_is_removed_and_nothing_else(tmp_path):
    from stackroom.session import remove_scratch

    keep, scratch = tmp_path / "keep", tmp_path / ("run-" + "0" * 32)
    keep.mkdir()
    scratch.mkdir()
    remove_scratch(str(scratch))
    with pytest.raises(ValueError):
        remove_scratch(str(keep))
    assert keep.exists() and not scratch.exists()


def test_catalog_switches(spark, folder, tmp_path):
    root, out = str(tmp_path / "root"), str(tmp_path / "catalog")
    datasets = staging.stage_folder(spark, str(folder), root, hold_partial_line=False)
    options = catalog.Options(kinds=("work",), do_covers=False, do_tags=False, do_sources=False, do_translations=False)
    catalog.build_catalog(spark, root, out, datasets, options=options)
    assert {r.kind for r in catalog.read_entities(spark, out).collect()} == {"work"}
    for table in ("covers", "tags", "tag_links", "source_records", "translations"):
        assert catalog.read_catalog(spark, out, table) is None


def records(spark, *values):
    from stackroom.operators import parse
    from stackroom.operators.entities import PLACE

    lines = spark.createDataFrame(
        [("d", f"f{batch}", i, line) for batch, i, line in values],
        "dataset string, source_file string, source_offset bigint, line string",
    )
    return parse.accepted(parse.json_records(lines)).withColumn("kind", F.lit("work")).select(
        "kind", *PLACE, "ol_key", "data_json", "data"
    )


def test_increments_give_what_one_batch_gives(spark, tmp_path):
    first = [(0, 0, record("work", 1, subjects=["A"])), (0, 1, record("work", 2, title="T"))]
    second = [
        (1, 0, record("work", 1, title="Late", subjects=["a", "B"], last_modified=stamp("2021-02-03"))),
        (1, 1, record("work", 2, title="ignored")),
        (1, 2, record("work", 3, subjects=["B"])),
    ]
    third = [(2, 0, record("work", 1, title="Later")), (2, 1, record("work", 3, title="Three"))]
    one, steps = str(tmp_path / "one"), str(tmp_path / "steps")
    catalog.update_catalog(spark, records(spark, *first, *second, *third), one)
    for batch, rows in enumerate((first, second, third)):
        catalog.update_catalog(spark, records(spark, *rows), steps, batch)
    # Run the last batch once more, as after a failure.
    catalog.update_catalog(spark, records(spark, *third), steps, 2)

    def view(root):
        entities = catalog.read_entities(spark, root)
        tags = catalog.tags_with_counts(spark, root)
        return (
            sorted(map(str, entities.select("ol_num", "name", "genres", "updated_at").collect())),
            sorted(map(str, tags.select("slug", "name", "items_count").collect())),
            catalog.read_catalog(spark, root, "tag_links").count(),
        )

    assert view(steps) == view(one)


def test_ids_survive_a_clash(spark):
    from stackroom.operators.ids import hashed, settled, with_ids

    id_of = hashed(["slug"], bits=2)
    old = settled(spark.createDataFrame([("a",), ("b",)], "slug string"), None, "id", ["slug"], id_of)
    before = {r.slug: r.id for r in old.collect()}
    new = settled(spark.createDataFrame([("c",), ("d",)], "slug string"), old, "id", ["slug"], id_of)
    every = old.unionByName(new)
    after = {r.slug: r.id for r in every.collect()}
    # Four keys take all four ids there are.
    assert sorted(after.values()) == [0, 1, 2, 3] and {k: after[k] for k in before} == before
    # Links hash their ids and look up only those that moved.
    links = with_ids(spark.createDataFrame([(s,) for s in "abcd"], "slug string"), every, "id", ["slug"], id_of)
    assert {r.slug: r.id for r in links.collect()} == after


def test_catalog_with_clashing_ids(spark, folder, tmp_path):
    root, out = str(tmp_path / "root"), str(tmp_path / "catalog")
    staging.stage_folder(spark, str(folder), root, hold_partial_line=False)
    catalog.build_catalog(spark, root, out, options=catalog.Options(id_bits=1))
    counts = {(r.slug, r.items_count) for r in catalog.tags_with_counts(spark, out).collect()}
    assert counts == {("sci-fi", 2), ("voina", 1)}


def test_a_dead_update_is_not_seen(spark, folder, tmp_path, monkeypatch):
    from stackroom.plans import commits

    root, out = str(tmp_path / "root"), str(tmp_path / "catalog")
    staging.stage_folder(spark, str(folder), root, hold_partial_line=False)

    def dies(*_):
        raise OSError("no space")

    with monkeypatch.context() as patch:
        patch.setattr(commits, "switch_text", dies)
        with pytest.raises(OSError):
            catalog.build_catalog(spark, root, out)
    assert catalog.read_entities(spark, out) is None
    assert catalog.build_catalog(spark, root, out)
    assert catalog.read_entities(spark, out).count() == 4
    version = commits.load(spark, out).version
    assert not catalog.build_catalog(spark, root, out)
    assert commits.load(spark, out).version == version
    # A rebuild writes beside what is read, and what nobody follows any more can go.
    assert catalog.build_catalog(spark, root, out, rebuild=True)
    commits.vacuum(spark, out, catalog.TABLES)
    assert [p.name for p in sorted((tmp_path / "catalog" / "entities").iterdir())] == ["generation=1"]
    assert catalog.read_entities(spark, out).count() == 4


def test_an_overtaken_update_starts_again(spark, tmp_path):
    from stackroom.plans import commits

    out = str(tmp_path / "catalog")
    rows = records(spark, (0, 0, record("work", 1, subjects=["A"])))
    real, others = catalog._add_records, [records(spark, (1, 0, record("work", 2, subjects=["A"])))]

    def slow(update, recs, options):
        real(update, recs, options)
        if others:
            catalog.update_catalog(spark, others.pop(), out, writer="other")

    catalog._add_records = slow
    try:
        catalog.update_catalog(spark, rows, out)
    finally:
        catalog._add_records = real
    assert [(r.slug, r.items_count) for r in catalog.tags_with_counts(spark, out).collect()] == [("a", 2)]
    late = commits.Update(spark, out, "late", None)
    catalog.recount_tags(spark, out)
    with pytest.raises(commits.Overtaken):
        late.switch()


def test_records_are_opened_once(spark):
    from stackroom.operators.entities import extract_records

    bodies = [
        '{"title":{"value":" t "},"name":5,"subjects":["A ",null,"b","a",""],"covers":[2,null,1,2,-1],'
        '"source_records":["ia:x"," y",":z","q:"],"created":{"value":"2020-01-02T03:04:05"}}',
        '{"title":"u","subjects":["x",5,null,{"a":1}],"genres":["g"],"covers":["3",4,1.5,"x"],'
        '"source_records":[1,"ia:w"],"created":{"value":"2020-01-02T03:04:05.6+01:00"}}',
        '{"title":null,"subjects":"x","covers":7,"created":{"value":"2020-01-02t030405"}}',
        '["no object"]',
        '{"created":{"value":"2020-13-02T03:04:05"},"birth_date":1999,"subjects":[]}',
    ]
    data = [("work", f"/works/OL{i}W", b, "d", "f", i) for i, b in enumerate(bodies, 1)]
    rows = spark.createDataFrame(
        data, "kind string, ol_key string, data_json string, dataset string, source_file string, source_offset bigint"
    )
    got = extract_records(functions_json.parse_once(rows, "data_json", "data"))
    # A look-up by path walks the record from its start: it is opened by one pass.
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall(r"try_variant_get\(data#[0-9]+,", plan)) == 1
    found = [
        (r.name, r.subjects, r.cover_ids, [(p.source, p.source_key) for p in r.source_records], str(r.created_at))
        for r in sorted(got.collect(), key=lambda r: r.ol_num)
    ]
    assert found == [
        ("t", ["A", "b"], [2, 1, -1], [("ia", "x"), ("unknown", "y"), ("unknown", "z")], "2020-01-02 03:04:05"),
        ("u", ["x", "g"], [3, 4], [("ia", "w")], "2020-01-02 03:04:05"),
        (None, [], [], [], "2020-01-02 03:04:05"),
        (None, [], [], [], "None"),
        (None, [], [], [], "None"),
    ]


def test_strict_type(spark):
    from stackroom.operators.entities import extract_records

    rows = records(spark, (0, 0, record("work", 1)), (0, 1, record("edition", 2)))
    assert extract_records(rows).count() == 2
    assert [r.ol_num for r in extract_records(rows, strict_type=True).collect()] == [1]


def test_stream_equals_batch(spark, folder, tmp_path):
    root, streamed = str(tmp_path / "root"), str(tmp_path / "streamed")
    path = str(folder / f"{WORKS}.txt")

    def run():
        stage_stream(spark, path, streamed, WORKS, f"{streamed}/checkpoint").awaitTermination()

    run()
    with open(path, "a", encoding="utf-8") as out:
        out.write(record("work", 2, title="known key") + "\n" + record("work", 3, title="new") + "\n")
    run()
    run()
    staging.stage_dataset(spark, files_of(spark, folder), root)

    def view(where):
        return [(r.source_offset, r.ol_key, r.data_json) for r in staged(spark, where)]

    assert view(streamed) == view(root)

    out = f"{streamed}/catalog"
    for _ in range(2):
        catalog_stream(spark, streamed, WORKS, "work", out, f"{streamed}/catalog_checkpoint").awaitTermination()
    names = {r.ol_num: r.name for r in catalog.read_entities(spark, out).collect()}
    assert names == {1: None, 2: "Two", 3: "new"}


def test_stream_holds_a_partial_line(spark, tmp_path):
    root, path = str(tmp_path / "root"), tmp_path / "ol_dump_x.txt"
    whole, cut = record("work", 1) + "\n", record("work", 2)
    path.write_text(whole + cut[:40])

    def run():
        stage_stream(spark, str(path), root, "x", f"{root}/checkpoint", hold_partial_line=True).awaitTermination()
        return [r.ol_key for r in staged(spark, root, "x")]

    assert run() == ["/works/OL1W"]
    path.write_text(whole + cut + "\n")
    assert run() == ["/works/OL1W", "/works/OL2W"]


def test_files_grow_in_mid_line(spark, tmp_path):
    import gzip

    lines = "".join(record("work", n, title="t" * (n % 50)) + "\n" for n in range(1, 400)).encode() + b"no end"
    whole = tmp_path / "one"
    whole.mkdir()
    (whole / f"{WORKS}.txt").write_bytes(lines)
    root = str(tmp_path / "root")
    staging.stage_folder(spark, str(whole), root)
    expected = [(r.source_offset, r.ol_key, r.data_json) for r in staged(spark, root)]
    assert len(expected) == 399
    cuts = [0, len(lines) // 3 + 7, 2 * len(lines) // 3, len(lines)]
    for name in (f"{WORKS}.txt", f"{WORKS}.txt.gz"):
        grown, root = tmp_path / f"grown{name[-3:]}", str(tmp_path / f"root{name[-3:]}")
        grown.mkdir()
        streamed = f"{root}-streamed"
        for a, b in zip(cuts, cuts[1:], strict=False):
            with (grown / name).open("ab") as out:
                part = lines[a:b]
                # Several members for each piece, cut anywhere.
                out.write(b"".join(gzip.compress(part[i : i + 5000]) for i in range(0, len(part), 5000)) if name.endswith(".gz") else part)
            staging.stage_dataset(spark, files_of(spark, grown), root, split_bytes=12000)
            stage_stream(spark, str(grown / name), streamed, WORKS, f"{streamed}/checkpoint").awaitTermination()
        for where in (root, streamed):
            assert [(r.source_offset, r.ol_key, r.data_json) for r in staged(spark, where)] == expected
        assert staging.stage_dataset(spark, files_of(spark, grown), root) is None
        # Told that the file is whole, the last line counts too.
        metrics = staging.stage_dataset(spark, files_of(spark, grown), root, hold_partial_line=False)
        assert metrics.first().total == 1


def test_a_cut_off_member_is_left_alone(spark, tmp_path):
    import gzip

    root, path = str(tmp_path / "root"), tmp_path / f"{WORKS}.txt.gz"
    first, second = (record("work", n).encode() + b"\n" for n in (1, 2))
    late = gzip.compress(second)
    path.write_bytes(gzip.compress(first) + late[:-12])
    staging.stage_dataset(spark, files_of(spark, tmp_path), root)
    assert [r.ol_key for r in staged(spark, root)] == ["/works/OL1W"]
    path.write_bytes(gzip.compress(first) + late)
    staging.stage_dataset(spark, files_of(spark, tmp_path), root)
    assert [r.ol_key for r in staged(spark, root)] == ["/works/OL1W", "/works/OL2W"]


def test_tsv_files_of_different_widths(spark, tmp_path):
    folder, root = tmp_path / "dumps", str(tmp_path / "root")
    folder.mkdir()
    (folder / "ol_dump_ratings_x.txt").write_text("a\tb\nc\td\n")
    (folder / "ol_dump_Ratings_x.txt").write_text("a\tb\tc\nshort\tline\n")
    (folder / "ol_dump_ratings_y.txt").write_text("\t".join("x" * 201) + "\n")
    (folder / f"{WORKS}.txt").write_text(record("work", 1) + "\n")
    with pytest.raises(ExceptionGroup):
        staging.stage_folder(spark, str(folder), root)
    rows = staged(spark, root, "ol_dump_ratings_x", "tsv", 3)
    assert {(r.c1, r.c2, r.c3) for r in rows} == {("a", "b", "c"), ("a", "b", None), ("c", "d", None)}
    # The dataset with too many columns does not stop later ones.
    assert [r.ol_key for r in staged(spark, root)] == ["/works/OL1W"]


def test_paths_only_spark_can_open(spark, folder, tmp_path):
    conf = spark._jsc.hadoopConfiguration()
    conf.set("fs.viewfs.mounttable.dumps.link./in", f"file://{folder}")
    root, plain = str(tmp_path / "root"), str(tmp_path / "plain")
    datasets = staging.stage_folder(spark, "viewfs://dumps/in", root, hold_partial_line=False)
    assert datasets == staging.stage_folder(spark, str(folder), plain, hold_partial_line=False)
    for name, kind in datasets.items():
        def view(where, name=name, kind=kind):
            return [tuple(r)[1:] for r in staged(spark, where, name, kind, 3 if kind == "tsv" else 0)]

        assert [r[:-2] for r in view(root)] == [r[:-2] for r in view(plain)]
    with pytest.raises(Exception, match="nosuch"):
        staging.stage_folder(spark, "nosuch://x/in", root)


def test_positions_over_blocks_by_the_text_reader(spark, tmp_path):
    from stackroom.sources.lines import read_lines, text_lines

    path = tmp_path / "x.txt"
    path.write_bytes(b"".join(b"%d\r\n" % (i * i) + (b"\xff\n" if i % 7 == 0 else b"\n") for i in range(3000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        got = {(r.source_offset, bytes(r.value)) for r in text_lines(spark, [str(path)]).collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    rows = read_lines(spark, str(path), raw=True).collect()
    assert got == {(r.source_offset, bytes(r.raw)) for r in rows} and len(rows) == len(got)


def test_replayed_rejects_leave_the_rest(spark, folder, tmp_path):
    root, dataset = str(tmp_path / "root"), "ol_dump_wikidata_latest"
    with (folder / f"{dataset}.txt").open("a") as out:
        out.write('Q3\tsee {"id":"Q3"}\n')
    staging.stage_dataset(spark, files_of(spark, folder, dataset), root)
    assert [bytes(r.raw) for r in staging.read_rejects(spark, root, dataset).orderBy("source_offset").collect()] == [
        b"Q2\tnope", b'Q3\tsee {"id":"Q3"}',
    ]
    (folder / f"{dataset}.txt").unlink()

    def relaxed(lines):
        return staging.parse_lines(lines, "wikidata", lenient=True)

    assert staging.replay_rejects(spark, root, dataset, "wikidata", relaxed) == 1
    assert staging.replay_rejects(spark, root, dataset, "wikidata", relaxed) == 0
    assert [r.wd_id for r in staged(spark, root, dataset, "wikidata")] == ["Q1", "Q3"]
    assert [r.reject_reason for r in staging.read_rejects(spark, root, dataset).collect()] == ["no_json"]
    assert "replay/0" in staging.staged_batches(spark, root, dataset)


def test_plan_and_stream_share_a_dataset(spark, folder, tmp_path):
    root, dataset = str(tmp_path / "root"), "ol_dump_ratings_latest"
    path = folder / f"{dataset}.txt"
    staging.stage_dataset(spark, files_of(spark, folder, dataset), root)
    with path.open("a") as out:
        out.write("x\ty\tz\n")
    for _ in range(2):
        stage_stream(spark, str(path), root, dataset, f"{root}/checkpoint", "tsv", 3).awaitTermination()
    staging.stage_dataset(spark, files_of(spark, folder, dataset), root)
    assert [r.c1 for r in staged(spark, root, dataset, "tsv", 3)] == ["/works/OL1W", "x"]
    assert staging.read_rejects(spark, root, dataset).count() == 1


def test_wide_rows_are_not_shuffled(spark, folder, tmp_path):
    root = str(tmp_path / "root")
    staging.stage_dataset(spark, files_of(spark, folder), root, hold_partial_line=False)
    lines = spark.createDataFrame(
        [("f", i, record("work", n).encode(), record("work", n)) for i, n in enumerate([2, 9, 9, 10])],
        "source_file string, source_offset bigint, raw binary, line string",
    )
    staging.parse_raw(lines, lambda rows: staging.parse_lines(rows, "json")).write.parquet(f"{root}/parsed")
    parsed = spark.read.parquet(f"{root}/parsed")
    existing = staging.read_staged(spark, root, WORKS, "json")
    repeated = staging.repeated_places(parsed, existing, "json")
    repeated.write.parquet(f"{root}/repeated")
    rows = staging.stage_rows(parsed, spark.read.parquet(f"{root}/repeated"))
    assert sorted(r.ol_key for r in rows.collect()) == ["/works/OL10W", "/works/OL9W"]
    # At any size of history: keys and places alone go through an exchange.
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plans = [repeated, staging.stage_rows(parsed, spark.read.parquet(f"{root}/repeated"))]
        for plan in (df._jdf.queryExecution().executedPlan().toString() for df in plans):
            exchanged = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
            assert not any("data" in line for line in exchanged)
        assert "BroadcastExchange" in plan and "Exchange hashpartitioning" not in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_small_dump_is_parsed_by_several_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(staging, "LEAST_SPLIT", 1000)
    folder, root = tmp_path / "split", str(tmp_path / "root")
    folder.mkdir()
    lines = [record("work", i + 1, title=f"T{i}") for i in range(400)]
    (folder / f"{WORKS}.txt").write_text("\n".join(lines) + "\n")
    parts = []
    write_parsed = staging.write_parsed
    monkeypatch.setattr(staging, "write_parsed", lambda parsed, *a: (parts.append(len(parsed.inputFiles())), write_parsed(parsed, *a)))
    staging.stage_folder(spark, str(folder), root)
    assert parts[0] >= spark.sparkContext.defaultParallelism
    assert staging.read_staged(spark, root, WORKS, "json").count() == 400
