"""Dump files: listing, routing by name, dataset names, first lines."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stackroom import fixed_values as fixed
from stackroom.session import small_frame
from stackroom.sources.lines import opens, read_first_line
from stackroom.sources.storage import list_files


@dataclass(frozen=True)
class DumpFile:
    path: str
    size: int
    kind: str
    dataset: str


def base_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def file_kind(path: Column) -> Column:
    """Record kind by file name; the first matching part wins."""
    name = F.lower(base_name(path))
    kind = F.lit(None).cast("string")
    for part, value in reversed(fixed.FILE_KIND_BY_NAME_PART):
        kind = F.when(F.contains(name, F.lit(part)), F.lit(value)).otherwise(kind)
    return F.coalesce(kind, F.lit(fixed.KIND_JSON))


def dataset_name(path: Column) -> Column:
    """Dataset name from a file name: extension off, odd characters to ``_``."""
    unzipped = F.regexp_replace(base_name(path), r"(?i)\.gz\z", "")
    # A leading dot does not start an extension.
    stem = F.regexp_replace(unzipped, r"^(.*[^.].*)\.[^.]*\z", "$1")
    safe = F.regexp_replace(F.lower(stem), "[^a-z0-9_]+", "_")
    return F.coalesce(
        F.nullif(F.btrim(safe, F.lit("_")), F.lit("")), F.lit(fixed.FALLBACK_DATASET)
    )


def scan_dump_files(spark: SparkSession, folder: str) -> DataFrame:
    """Dump files of a folder, by name: path, size, kind, dataset.

    One row per file, so this is metadata, not data.
    """
    found = [f for f in list_files(spark, folder) if _is_dump(f[0].rsplit("/", 1)[-1])]
    files = small_frame(
        spark,
        "source_file string, file_size bigint",
        source_file=[path for path, _ in found],
        file_size=[size for _, size in found],
    )
    return files.select(
        "source_file",
        "file_size",
        file_kind(F.col("source_file")).alias("kind"),
        dataset_name(F.col("source_file")).alias("dataset"),
    ).orderBy("source_file")


def _is_dump(name: str) -> bool:
    return name.startswith(fixed.DUMP_PREFIX) and name.endswith(
        (fixed.DUMP_SUFFIX, fixed.DUMP_SUFFIX + ".gz")
    )


def dump_files(spark: SparkSession, folder: str) -> list[DumpFile]:
    """``scan_dump_files`` for planning: readers and schemas are chosen per file."""
    return [
        DumpFile(r["source_file"], r["file_size"], r["kind"], r["dataset"])
        for r in scan_dump_files(spark, folder).collect()
    ]


def count_columns(spark: SparkSession, path: str) -> int:
    """Number of tab fields in the first line, which fixes the schema of a TSV file."""
    if opens(path):
        line = read_first_line(path, fixed.FIRST_LINE_BYTES)
    else:
        first = spark.read.option("lineSep", "\n").text(path).select(F.col("value").cast("binary")).first()
        line = bytes(first[0]) if first else b""
    line = line.rstrip(b"\r\n")
    if not line:
        raise ValueError(f"empty first line: {path}")
    columns = line.count(b"\t") + 1
    if columns > fixed.MAX_TSV_COLUMNS:
        raise ValueError(f"{columns} columns in the first line: {path}")
    return columns
