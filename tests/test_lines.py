"""Byte positions are exact whatever the split size, and files are routed by name."""

import gzip
import random

import pytest
from pyspark.sql import functions as F

from stackroom.sources import files, lines
from stackroom.sources.lines import list_files, read_lines


def make_lines(seed=1, count=600):
    rng = random.Random(seed)
    lines = [
        ("é" * rng.randint(0, 9) + "x" * rng.choice([0, 1, 50, 300]) + rng.choice(["", "\r"])).encode()
        for _ in range(count)
    ]
    lines[7] = b"\xff\xfebad"
    return lines


def with_positions(lines):
    result, position = [], 0
    for line in lines:
        result.append((position, line.decode("utf-8", "replace")))
        position += len(line) + 1
    return result


def read(spark, path, **options):
    rows = read_lines(spark, str(path), **options).collect()
    return sorted((r.source_offset, r.line) for r in rows)


@pytest.mark.parametrize("split_bytes", [3001, 20_000, 1 << 20])
@pytest.mark.parametrize("last_end", [b"", b"\n"])
def test_positions(spark, tmp_path, split_bytes, last_end):
    lines = make_lines()
    path = tmp_path / "ol_dump_a.txt"
    path.write_bytes(b"\n".join(lines) + last_end)
    assert read(spark, path, split_bytes=split_bytes) == with_positions(lines)


def test_positions_with_a_line_larger_than_a_split(spark, tmp_path):
    lines = [b"a" * 300_000, b"b", b"c" * 200_000, b"", b"d"]
    path = tmp_path / "ol_dump_a.txt"
    path.write_bytes(b"\n".join(lines))
    assert read(spark, path, split_bytes=70_000) == with_positions(lines)


def test_zipped_in_members(spark, tmp_path):
    lines = make_lines()
    data = b"\n".join(lines)
    path = tmp_path / "ol_dump_a.txt.gz"
    path.write_bytes(gzip.compress(data[:5000]) + gzip.compress(data[5000:]))
    assert read(spark, path) == with_positions(lines)


def test_marks_and_ends(spark, tmp_path):
    lines = make_lines()
    expected = with_positions(lines)
    path = tmp_path / "ol_dump_a.txt"
    path.write_bytes(b"\n".join(lines))
    mark, end = expected[200][0], expected[500][0]
    got = read(spark, path, split_bytes=9000, marks={str(path): mark}, ends={str(path): end})
    assert got == expected[200:500]


def test_empty_file(spark, tmp_path):
    path = tmp_path / "ol_dump_a.txt"
    path.write_bytes(b"")
    assert read(spark, path) == []


def test_scan_and_route(spark, tmp_path):
    names = [
        "ol_dump_works_latest.txt", "ol_dump_covers_metadata_latest.txt", "ol_dump_ratings.txt",
        "ol_dump_reading-log.txt.gz", "ol_dump_wikidata_ratings.txt", "other.txt", "ol_dump_x.csv",
    ]
    for name in names:
        (tmp_path / name).write_bytes(b"x")
    found = [(f.path.rsplit("/", 1)[-1], f.kind, f.dataset) for f in files.dump_files(spark, str(tmp_path))]
    assert found == [
        ("ol_dump_covers_metadata_latest.txt", "covers", "ol_dump_covers_metadata_latest"),
        ("ol_dump_ratings.txt", "tsv", "ol_dump_ratings"),
        ("ol_dump_reading-log.txt.gz", "tsv", "ol_dump_reading_log"),
        ("ol_dump_wikidata_ratings.txt", "wikidata", "ol_dump_wikidata_ratings"),
        ("ol_dump_works_latest.txt", "json", "ol_dump_works_latest"),
    ]


def test_dataset_name(spark):
    cases = {
        "/d/OL_Dump Reading-log.TXT": "ol_dump_reading_log", "---.txt": "ol_dump",
        "a.b.txt": "a_b", ".hidden": "hidden", "x": "x",
    }
    rows = spark.createDataFrame([(k,) for k in cases], "p string")
    got = [r.d for r in rows.select(files.dataset_name(F.col("p")).alias("d")).collect()]
    assert got == list(cases.values())


def test_count_columns(spark, tmp_path):
    def columns(data):
        path = tmp_path / "f.txt"
        path.write_bytes(data)
        return files.count_columns(spark, str(path))

    assert columns(b"a\tb\tc\r\nx") == 3
    assert columns(b"a") == 1
    for bad in (b"", b"\nx\ty", b"\t".join([b"a"] * 201)):
        with pytest.raises(ValueError):
            columns(bad)


def test_list_files_recursive(tmp_path):
    (tmp_path / "p=1").mkdir()
    (tmp_path / "p=1" / "a").write_bytes(b"12")
    (tmp_path / "_SUCCESS").write_bytes(b"")
    assert list_files(str(tmp_path)) == []
    assert list_files(str(tmp_path), recursive=True) == [(str(tmp_path / "p=1" / "a"), 2)]


def test_count_columns_of_a_long_line(spark, tmp_path):
    path = tmp_path / "long.txt"
    for size in (4095, 4096, 5000):
        path.write_bytes(b"\t".join([b"x" * size] * 6) + b"\r\ny\tz\n")
        assert files.count_columns(spark, str(path)) == 6


def test_many_small_splits_share_tasks():
    splits = [s for i in range(3000) for s in lines.plan_splits(f"/f{i}", 0, 300_000, 65536)]
    tasks = lines.packed(splits)
    assert [s for task in tasks for s in task.splits] == splits
    assert lines.MANY_TASKS <= len(tasks) <= 2 * lines.MANY_TASKS
    few = lines.plan_splits("/f", 0, 300_000, 65536)
    assert [task.splits for task in lines.packed(few)] == [[s] for s in few]
    assert lines.packed([]) == [] and list(lines.read_task(None)) == []


def test_packed_splits_hold_every_line_once(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(lines, "MANY_TASKS", 3)
    for i in range(20):
        (tmp_path / f"f{i}").write_text("".join(f"{i} {k}\n" for k in range(50)))
    found = lines.read_lines(spark, str(tmp_path), 64)
    assert found.rdd.getNumPartitions() <= 6
    assert sorted(r.line for r in found.collect()) == sorted(f"{i} {k}" for i in range(20) for k in range(50))
