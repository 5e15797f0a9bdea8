"""Lines of text files with the byte position each line starts at.

Spark's text reader does not tell where a line starts, and a running sum over line
lengths would shuffle and sort every dump once.  A Python data source knows the position
while it reads: each task opens its byte range, finds line ends a chunk at a time and hands
Arrow batches to Spark.  Nothing is shuffled, splits keep huge files parallel, and the
same positions serve as the offsets of a streaming read.

A line belongs to the split its first byte lies in, so every line is read exactly once
whatever the split size.  Positions in zipped files count unzipped bytes.  A zipped file is one split
unless the places of its gzip members are given (``gzip_members``): then they are dealt to tasks, and a
file that has grown is read from its last members on.

Files of schemes that only Spark opens are read by its own text reader; positions then come from sums of
line lengths (``text_lines``).
"""

from __future__ import annotations

import json
import sys
import zlib
from dataclasses import dataclass

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    DataSourceStreamReader,
    InputPartition,
)

from stackroom.session import small_frame
from stackroom.sources import storage

# Executors need only pyarrow and numpy: the classes below travel by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

FORMAT = "positioned_lines"
SCHEMA = "source_file string, source_offset bigint, value binary"
SPLIT_BYTES = 128 * 1024 * 1024
CHUNK_BYTES = 8 * 1024 * 1024
MANY_TASKS = 256


def _open_filesystem(path: str):
    from pyarrow import fs

    if path.startswith("file:"):
        path = "/" + path[len("file:"):].lstrip("/")
    if "://" in path:
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


def _is_zipped(path: str) -> bool:
    return path.lower().endswith(".gz")


def list_files(path: str, recursive: bool = False) -> list[tuple[str, int]]:
    """(path, size) of a file, or of the files of a folder in name order."""
    from pyarrow import fs

    filesystem, local = _open_filesystem(path)
    info = filesystem.get_file_info(local)
    if info.type == fs.FileType.File:
        return [(path, info.size)]
    found = filesystem.get_file_info(fs.FileSelector(local, recursive=recursive))
    prefix, below = path.rstrip("/"), len(local.rstrip("/"))
    return sorted(
        (prefix + f.path[below:], f.size)
        for f in found
        if f.type == fs.FileType.File and not f.base_name.startswith(("_", "."))
    )


def list_folders(path: str) -> list[str]:
    """Names of the folders in a folder, in order."""
    from pyarrow import fs

    filesystem, local = _open_filesystem(path)
    found = filesystem.get_file_info(fs.FileSelector(local, recursive=False))
    return sorted(f.base_name for f in found if f.type == fs.FileType.Directory)


def exists(path: str) -> bool:
    from pyarrow import fs

    filesystem, local = _open_filesystem(path)
    return filesystem.get_file_info(local).type != fs.FileType.NotFound


def read_first_line(path: str, block: int) -> bytes:
    """The first line without its end, however long, read in blocks."""
    filesystem, local = _open_filesystem(path)
    parts = []
    with filesystem.open_input_stream(local, compression="detect") as stream:
        while part := stream.read(block):
            parts.append(part.split(b"\n", 1)[0])
            if len(parts[-1]) < len(part):
                break
    return b"".join(parts)


@dataclass
class LineSplit(InputPartition):
    path: str
    start: int  # first byte of the range
    end: int  # lines that start before this byte belong to the split; -1: to the end
    aligned: bool  # the range is known to begin with a line
    stop: int  # bytes from here on are not read; -1: to the end
    zip_offset: int = 0  # where reading begins in a zipped file: a member, and
    zip_plain: int = 0  # its position in unzipped bytes
    hold: bool = False  # a last line without its end is left out


@dataclass
class LineTask(InputPartition):
    """Splits that one task reads one after the other."""

    splits: list[LineSplit]


def packed(splits: list[LineSplit]) -> list[LineTask]:
    """Splits dealt to ``MANY_TASKS`` tasks or so, in order; to more if a task had above ``SPLIT_BYTES`` then.

    A task costs as much as reading some hundred kilobytes, so many small files or splits share one.  Splits
    of unknown size have one each.
    """
    sizes = [s.end - s.start if s.end >= 0 else SPLIT_BYTES for s in splits]
    most = min(SPLIT_BYTES, sum(sizes) // MANY_TASKS)
    tasks: list[LineTask] = []
    held = most
    for split, size in zip(splits, sizes, strict=True):
        if not tasks or held + size > most:
            tasks.append(LineTask([]))
            held = 0
        tasks[-1].splits.append(split)
        held += size
    return tasks


def plan_splits(
    path: str, start: int, size: int, split_bytes: int, stop: int = -1,
    members: list[list[int]] | None = None, hold: bool = False,
) -> list[LineSplit]:
    """Byte ranges that cover ``path`` from ``start`` to ``size``.

    ``members`` are places in a zipped file where reading can begin: zipped offset, unzipped position, and
    whether a line begins there.
    """
    if _is_zipped(path):
        if not members:
            # ``size`` counts zipped bytes here; skip lines before ``start`` while reading.
            return [LineSplit(path, start, -1, True, stop, hold=hold)]
        ends = [plain for _, plain, _ in members[1:]] + [stop]
        return [
            # Lines before ``start`` are done; the first member may begin in the middle of one.
            LineSplit(path, max(plain, start), end, bool(aligned) or plain <= start, stop, at, plain)
            for (at, plain, aligned), end in zip(members, ends, strict=True)
            if end < 0 or end > start
        ]
    return [
        LineSplit(path, at, min(at + split_bytes, size), at == start, stop)
        for at in range(start, size, split_bytes)
    ]


class _Inflated:
    """Unzipped bytes of a file from one of its members on."""

    def __init__(self, stream):
        self.stream = stream
        self.member, self.waiting = None, b""
        #: Zipped bytes read, and those of members read to their end.
        self.taken = self.whole = 0

    def read(self, want: int) -> bytes:
        """Up to ``want`` bytes, never beyond a member's end; nothing at the end or if a member is cut off."""
        while True:
            if not self.waiting:
                self.waiting = self.stream.read(1 << 20)
                self.taken += len(self.waiting)
            if self.member is None:
                self.waiting = self.waiting.lstrip(b"\0")  # padding between members
            if not self.waiting:
                return b""
            if self.member is None:
                self.member = zlib.decompressobj(31)
            part = self.member.decompress(self.waiting, want)
            if self.member.eof:
                self.waiting, self.member = self.member.unused_data, None
                self.whole = self.taken - len(self.waiting)
            else:
                self.waiting = self.member.unconsumed_tail
            if part:
                return part

    def __enter__(self):
        return self

    def __exit__(self, *_):
        self.stream.close()


def index_members(path: str, zip_offset: int, zip_plain: int, every: int) -> dict:
    """Where a zipped file can be read from, by unzipping it once from one of its members on.

    members: [zipped offset, unzipped position, whether a line begins there], ``every`` unzipped bytes or
    more apart; plain_end: unzipped size up to the last whole member; line_end: the end of the last whole
    line before; zip_offset and zip_plain: the last member that begins at or before line_end.
    """
    filesystem, local = _open_filesystem(path)
    raw = filesystem.open_input_file(local)
    raw.seek(zip_offset)
    members = [[zip_offset, zip_plain, int(zip_plain == 0)]]
    resume, ahead = (zip_offset, zip_plain), []
    position = plain_end = line_end = newline = zip_plain
    with _Inflated(raw) as stream:
        whole, last = 0, b"\n" if zip_plain == 0 else b""
        while block := stream.read(CHUNK_BYTES):
            cut = block.rfind(b"\n") + 1
            if cut:
                newline = position + cut
            position += len(block)
            last = block[-1:]
            if stream.whole > whole:
                whole, plain_end, line_end = stream.whole, position, newline
                ahead.append((zip_offset + whole, position))
                while ahead and ahead[0][1] <= line_end:
                    resume = ahead.pop(0)
                if position - members[-1][1] >= every:
                    members.append([zip_offset + whole, position, int(last == b"\n")])
    if len(members) > 1 and members[-1][1] == plain_end:
        members.pop()
    return {
        "members": members, "plain_end": plain_end, "line_end": line_end,
        "zip_offset": resume[0], "zip_plain": resume[1],
    }


def gzip_members(
    spark: SparkSession, files: dict[str, tuple[int, int]], split_bytes: int = SPLIT_BYTES
) -> dict[str, dict]:
    """``index_members`` of files, each from a (zipped offset, unzipped position); one task for each.

    What comes back is planning data: one place for each split to be read.
    """
    if not files:
        return {}
    import pyarrow as pa

    def index(batches):
        for batch in batches:
            for row in batch.to_pylist():
                found = index_members(row["path"], row["zip_offset"], row["zip_plain"], split_bytes)
                yield pa.RecordBatch.from_pylist([{"path": row["path"], "found": json.dumps(found)}])

    rows = small_frame(
        spark, "path string, zip_offset bigint, zip_plain bigint", path=list(files),
        zip_offset=[at for at, _ in files.values()], zip_plain=[plain for _, plain in files.values()],
    )
    spread = rows.repartitionByRange(len(files), "path")
    return {
        r["path"]: json.loads(r["found"])
        for r in spread.mapInArrow(index, "path string, found string").collect()
    }


def _chunks(stream, stop: int, position: int, end: int, hold: bool = False):
    """Byte chunks that end with a line end, each with the position it starts at.

    The last one may lack it, unless ``hold`` leaves it out.
    """
    carry = b""
    while True:
        # A chunk at most, less near the end of the range, more within a huge line.
        want = CHUNK_BYTES if end < 0 else min(CHUNK_BYTES, max(65536, end - position))
        want = max(want, len(carry))
        if stop >= 0:
            want = min(want, stop - position - len(carry))
        block = stream.read(want) if want > 0 else b""
        if not block:
            break
        # Search only the new part: a line may span many blocks.
        cut = block.rfind(b"\n") + 1
        if cut == 0:
            carry += block
            continue
        data = carry + block[:cut]
        yield position, data
        position += len(data)
        carry = block[cut:]
    if carry and not hold:
        yield position, carry


def read_split(split: LineSplit):
    """Arrow batches (source_file, source_offset, value) of one split."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    filesystem, local = _open_filesystem(split.path)
    zipped = _is_zipped(split.path)
    stream = filesystem.open_input_file(local)
    if zipped:
        begin = split.zip_plain
        stream.seek(split.zip_offset)
        stream = _Inflated(stream)
        # What begins in the middle of a line has its first line one byte later at the earliest.
        lowest = split.start if split.aligned else split.start + 1
    else:
        # One byte earlier tells whether the range begins with a line.
        begin = 0 if split.start == 0 else split.start - (0 if split.aligned else 1)
        stream.seek(begin)
        lowest = split.start
    with stream:
        for position, data in _chunks(stream, split.stop, begin, split.end, split.hold):
            body = data[:-1] if data.endswith(b"\n") else data
            lines = pc.split_pattern(pa.array([body], pa.binary()), pattern=b"\n").flatten()
            lengths = pc.binary_length(lines).to_numpy(zero_copy_only=False).astype(np.int64)
            starts = np.empty(len(lengths), np.int64)
            starts[0] = position
            np.cumsum(lengths[:-1] + 1, out=starts[1:])
            starts[1:] += position
            first = int(np.searchsorted(starts, lowest))
            last = len(starts) if split.end < 0 else int(np.searchsorted(starts, split.end))
            if first < last:
                count = last - first
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.repeat(pa.scalar(split.path, pa.string()), count),
                        pa.array(starts[first:last]),
                        lines.slice(first, count),
                    ],
                    names=["source_file", "source_offset", "value"],
                )
            if split.end >= 0 and position + len(data) >= split.end:
                return


def read_task(task: LineTask | None):
    # No files match: Spark asks for one empty partition.
    for split in task.splits if task is not None else ():
        yield from read_split(split)


class _Options:
    def __init__(self, options: dict):
        self.paths = json.loads(options["paths"])
        self.split_bytes = int(options.get("splitbytes") or SPLIT_BYTES)
        self.marks = json.loads(options.get("marks") or "{}")
        self.ends = json.loads(options.get("ends") or "{}")
        self.members = json.loads(options.get("members") or "{}")
        self.recursive = (options.get("recursive") or "false").lower() == "true"
        self.hold_partial = (options.get("holdpartialline") or "false").lower() == "true"

    def files(self) -> list[tuple[str, int]]:
        return [file for path in self.paths for file in list_files(path, self.recursive)]


class _BatchReader(DataSourceReader):
    def __init__(self, options: dict):
        self.options = _Options(options)

    def partitions(self):
        marks, ends = self.options.marks, self.options.ends
        # With given ends nothing has to be listed, and later appends are not read.
        files = sorted(ends.items()) if ends else self.options.files()
        return packed([
            split
            for path, size in files
            for split in plan_splits(
                path, marks.get(path, 0), size, self.options.split_bytes, ends.get(path, -1),
                self.options.members.get(path),
            )
        ])

    def read(self, partition):
        return read_task(partition)


class _StreamReader(DataSourceStreamReader):
    """Offsets are ``{file: bytes read}``, so appended tails are picked up exactly."""

    def __init__(self, options: dict):
        self.options = _Options(options)

    def initialOffset(self):
        return dict(self.options.marks)

    def latestOffset(self):
        ends = {}
        for path, size in self.options.files():
            ends[path] = _last_line_end(path, size) if self.options.hold_partial else size
        return ends

    def partitions(self, start, end):
        splits = []
        for path, size in sorted(end.items()):
            done = start.get(path, 0)
            if _is_zipped(path):
                # Zipped files are read whole whenever they have grown: their unzipped places tell
                # what was there before.
                if size > done:
                    splits += plan_splits(path, 0, size, self.options.split_bytes, hold=self.options.hold_partial)
            elif size > done:
                splits += plan_splits(path, done, size, self.options.split_bytes, stop=size)
        return packed(splits)

    def read(self, partition):
        return read_task(partition)

    def commit(self, end):
        pass


def _last_line_end(path: str, size: int) -> int:
    """Position after the last line end of a file that may still be written to."""
    if _is_zipped(path):
        return size
    filesystem, local = _open_filesystem(path)
    with filesystem.open_input_file(local) as stream:
        end = size
        while end > 0:
            begin = max(0, end - 65536)
            stream.seek(begin)
            cut = stream.read(end - begin).rfind(b"\n")
            if cut >= 0:
                return begin + cut + 1
            end = begin
    return 0


class PositionedLines(DataSource):
    @classmethod
    def name(cls):
        return FORMAT

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return _BatchReader(dict(self.options))

    def streamReader(self, schema):
        return _StreamReader(dict(self.options))


def _with_options(reader, paths, split_bytes, marks, recursive, **more):
    reader = (
        reader.format(FORMAT)
        .option("paths", json.dumps([paths] if isinstance(paths, str) else list(paths)))
        .option("splitBytes", str(split_bytes))
        .option("marks", json.dumps(marks or {}))
        .option("recursive", str(recursive).lower())
    )
    for key, value in more.items():
        reader = reader.option(key, value)
    return reader


def as_lines(rows: DataFrame, raw: bool = False) -> DataFrame:
    """Bytes to text; broken UTF-8 becomes U+FFFD.  Positions are already fixed.

    ``raw`` keeps the bytes beside the text.
    """
    return rows.select(
        "source_file",
        "source_offset",
        *([F.col("value").alias("raw")] if raw else []),
        F.make_valid_utf8(F.col("value").cast("string")).alias("line"),
    )


def last_line_end(path: str, size: int) -> int:
    """Where the last whole line of a plain file ends."""
    return _last_line_end(path, size) if opens(path) else size


def opens(path: str) -> bool:
    """Whether the positioned source knows the path's scheme; others are left to Spark's own readers."""
    import pyarrow as pa

    try:
        _open_filesystem(path)
    except (pa.ArrowInvalid, NotImplementedError, OSError):
        return False
    return True


def text_lines(
    spark: SparkSession, paths: list[str], marks: dict[str, int] | None = None, ends: dict[str, int] | None = None
) -> DataFrame:
    """(source_file, source_offset, value) of files only Spark can open, by its own text reader.

    A line's position is the sum of the lengths before it: within its block of the file by a window, and
    over the blocks by one row for each.
    """
    result = None
    for path in paths:
        lines = spark.read.option("lineSep", "\n").text(path).select(
            F.col("value").cast("binary").alias("value"),
            F.col("_metadata.file_block_start").alias("_block"),
            F.monotonically_increasing_id().alias("_at"),
        ).withColumn("_size", F.octet_length("value") + F.lit(1).cast("bigint"))
        within = Window.partitionBy("_block").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
        before = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
        sizes = lines.groupBy("_block").agg(F.sum("_size").alias("_whole"))
        begins = sizes.select("_block", F.coalesce(F.sum("_whole").over(before), F.lit(0)).alias("_begin"))
        offset = F.col("_begin") + F.coalesce(F.sum("_size").over(within), F.lit(0))
        found = lines.join(begins, "_block").select(
            F.lit(path).alias("source_file"), offset.alias("source_offset"), "value"
        ).filter(F.col("source_offset") >= (marks or {}).get(path, 0))
        if ends and path in ends and not _is_zipped(path):
            found = found.filter(F.col("source_offset") < ends[path])
        result = found if result is None else result.unionByName(found)
    return result


def read_lines(
    spark: SparkSession,
    paths: str | list[str],
    split_bytes: int = SPLIT_BYTES,
    marks: dict[str, int] | None = None,
    ends: dict[str, int] | None = None,
    recursive: bool = False,
    members: dict[str, list[list[int]]] | None = None,
    raw: bool = False,
) -> DataFrame:
    """(source_file, source_offset, line) of files or folders, with ``raw`` bytes if asked for.

    ``marks`` maps a file to the byte its reading starts at, ``ends`` to the byte it stops
    at; what lies outside is never read.  ``members`` has the places zipped files are read from.
    """
    named = [paths] if isinstance(paths, str) else list(paths)
    if named and not all(opens(path) for path in named):
        files = [file for path in named for file, _ in storage.list_files(spark, path, recursive)]
        return as_lines(text_lines(spark, files, marks, ends), raw)
    spark.dataSource.register(PositionedLines)
    reader = _with_options(
        spark.read, paths, split_bytes, marks, recursive,
        ends=json.dumps(ends or {}), members=json.dumps(members or {}),
    )
    return as_lines(reader.load(), raw)


def stream_lines(
    spark: SparkSession,
    paths: str | list[str],
    split_bytes: int = SPLIT_BYTES,
    marks: dict[str, int] | None = None,
    recursive: bool = False,
    hold_partial_line: bool = True,
    raw: bool = False,
) -> DataFrame:
    """``read_lines`` as a stream: new files and appended tails.

    ``hold_partial_line`` leaves a last line without its line end for the next read; without it a file's
    end ends its line.  A zipped file that has grown comes whole once more.
    """
    spark.dataSource.register(PositionedLines)
    reader = _with_options(
        spark.readStream, paths, split_bytes, marks, recursive,
        holdPartialLine=str(hold_partial_line).lower(),
    )
    return as_lines(reader.load(), raw)
