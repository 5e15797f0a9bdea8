"""Converter of legacy ARC archives to WARC.

An ARC archive is a row (``name``, ``content``), as Spark's ``binaryFile`` source gives it.  Its
first record, ``filedesc://``, says by its version which fields a header line has: version 1 has
URL, address, date, type and length; version 2 adds result code, checksum, location, offset and
file name.  Records are found by their declared lengths alone, so payloads may hold anything.
A record becomes a WARC response with a synthetic identifier (a hash of archive name and offset), the date
in ISO form, block and payload digests; of records with equal payloads of ``min_bytes`` or more the one
with the largest key is the response and the others become revisits without payload.

WARC records end in two line ends, so Spark's text writer with that line separator writes
WARC files, with Spark's committing of tasks.  ``read_warc`` reads such files back.

Which record answers for a payload is found on narrow rows (key, digest), with partial
aggregation before the shuffle; payloads are shuffled once, by key, for the payloads' own join.

Defined results: a null body is empty; a null or empty URL is written as ``-``, white space and
control characters in URLs are percent-encoded; repeated rows are repeated records, of which one, the first in
its archive, is the response where keys are equal too; an archive that ends early or does not start with a
version block raises ``ValueError`` with its name; an empty table gives no archive.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stackroom.llm.store import stored
from stackroom.llm.words import utf8, values

#: The fields of an ARC header line, by version.
ARC_FIELDS = {
    b"1": b"URL IP-address Archive-date Content-type Archive-length",
    b"2": b"URL IP-address Archive-date Content-type Result-code Checksum Location Offset "
    b"Filename Archive-length",
}
#: HTTP header that carries a source row's key through an archive.
KEY_HEADER = b"X-Record-Key"
END = b"\r\n\r\n"
DATE = b"20240101000000"


def arc_url(url: bytes | None) -> bytes:
    """A URL without white space, control characters or bytes beyond ASCII."""
    return quote(url or b"-", safe="!#$%&'()*+,/:;=?@[]~_.-\\^`{|}<>\"").encode()


def arc_record(version: bytes, url: bytes, block: bytes, name: bytes, offset: int) -> bytes:
    size = str(len(block)).encode()
    middle = b"" if version == b"1" else b" ".join(
        [b"200", hashlib.md5(block).hexdigest().encode(), b"-", str(offset).encode(), name, b""]
    )
    return b"%s 0.0.0.0 %s text/html %s%s\n%s\n" % (url, DATE, middle, size, block)


def arc_archive(version: bytes, name: bytes, rows: list[tuple]) -> bytes:
    """An archive of (key, url, body) rows."""
    about = b"%s 0 Stackroom\n%s\n" % (version, ARC_FIELDS[version])
    out = [b"filedesc://%s 0.0.0.0 %s text/plain " % (name, DATE)]
    if version == b"2":
        out.append(b"200 - - 0 %s " % name)
    out.append(b"%d\n%s\n" % (len(about), about))
    offset = sum(map(len, out))
    for key, url, body in rows:
        body = body or b""
        block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\nContent-Length: %d\r\n%s: %s\r\n\r\n%s" % (
            len(body), KEY_HEADER, b"" if key is None else str(key).encode(), body,
        )
        record = arc_record(version, arc_url(url), block, name, offset)
        offset += len(record)
        out.append(record)
    return b"".join(out)


def write_arcs(rows: DataFrame, key: str, url: str, body: str) -> DataFrame:
    """(name, content) archives of both versions, one for each batch of rows."""
    narrow = rows.select(
        F.col(key).cast("long").alias("key"), F.col(url).cast("string").alias("url"),
        F.col(body).cast("string").alias("body"),
    )

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        for number, batch in enumerate(batches):
            if batch.num_rows:
                records = list(
                    zip(values(batch, "key"), utf8(batch, "url"), utf8(batch, "body"), strict=True)
                )
                keys = repr([r[0] for r in records]).encode()
                place = hashlib.sha1(keys).hexdigest()[:16].encode(), part, number
                name = b"pages-%s-%d-%d.arc" % place
                version = b"12"[len(records) % 2 :][:1]
                content = arc_archive(version, name, records)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name.decode()]), pa.array([content], pa.binary())],
                    names=["name", "content"],
                )

    # Written down, so that names stay what they are; packed well, as they hold every payload.
    return stored(narrow.mapInArrow(build, "name string, content binary"), "arcs", compression="zstd")


def _arc_records(name: str, content: bytes) -> Iterator[tuple[int, dict[bytes, bytes], bytes]]:
    """(offset, header fields, block) of each record behind the version block."""
    if content[:2] == b"\x1f\x8b":
        content = gzip.decompress(content)
    if not content.startswith(b"filedesc://"):
        raise ValueError(f"{name}: no version block")
    at, fields = 0, None
    while at < len(content):
        line_end = content.find(b"\n", at)
        header = content[at:line_end].split(b" ") if line_end >= 0 else [b""]
        if not header[-1].strip().isdigit():
            raise ValueError(f"{name}: no header line at byte {at}")
        start, size = line_end + 1, int(header[-1])
        block = content[start : start + size]
        if len(block) < size:
            raise ValueError(f"{name}: the record at byte {at} ends early")
        if fields is None:
            version = block.split(b" ", 1)[0]
            if version not in ARC_FIELDS:
                raise ValueError(f"{name}: unknown version {version!r}")
            fields = ARC_FIELDS[version].split(b" ")
        else:
            if len(header) != len(fields):
                raise ValueError(f"{name}: {len(header)} fields at byte {at}")
            yield at, dict(zip(fields, header, strict=True)), block
        at = start + size
        at += content[at : at + 1] == b"\n"


def _http(block: bytes) -> tuple[bytes, bytes]:
    """HTTP head, with its empty line, and body."""
    at = block.find(END)
    return (block, b"") if at < 0 else (block[: at + 4], block[at + 4 :])


def _field(head: bytes, name: bytes) -> bytes | None:
    found = re.search(rb"(?im)^%s:[ \t]*([^\r\n]*)" % re.escape(name), head)
    return found[1] if found else None


def _key(head: bytes) -> int | None:
    value = _field(head, KEY_HEADER)
    return int(value) if value else None


def _record_id(name: str, offset: int) -> str:
    digest = hashlib.sha1(f"{name}:{offset}".encode()).hexdigest()
    return f"{digest[:8]}-{digest[8:12]}-5{digest[13:16]}-8{digest[17:20]}-{digest[20:32]}"


def _digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def records(archives: DataFrame, payloads: bool = True) -> DataFrame:
    """record_id, key, url, date, digest, bytes and, if asked for, block of every ARC record."""
    fields = "record_id string, key long, url string, date string, digest string, bytes long"
    if payloads:
        fields += ", block string"

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(values(batch, "name"), values(batch, "content"), strict=True):
                out = []
                for at, header, block in _arc_records(name, content):
                    head, body = _http(block)
                    d = header[b"Archive-date"].decode()
                    date = f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"
                    row = (_record_id(name, at), _key(head), header[b"URL"].decode(), date,
                           _digest(body), len(body))
                    out.append((*row, block) if payloads else row)
                names = [f.split(" ")[0] for f in fields.split(", ")]
                kinds = {"long": pa.int64(), "string": pa.string()}
                types = [kinds[f.split(" ")[1]] for f in fields.split(", ")]
                columns = list(zip(*out, strict=True)) if out else [[] for _ in names]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names
                )

    return archives.select("name", "content").mapInArrow(parse, fields)


def revisits(narrow: DataFrame, min_bytes: int = 1000) -> DataFrame:
    """record_id of each revisit and, as ``response``, id and key of the record it refers to."""
    large = narrow.filter(F.col("bytes") >= min_bytes).select("record_id", "key", "digest")
    order = F.struct(F.coalesce("key", F.lit(-(2**63))).alias("k"), "record_id", "key")
    answers = (
        large.groupBy("digest").agg(F.max(order).alias("response"), F.count("*").alias("n"))
        .filter(F.col("n") > 1).drop("n")
    )
    return large.join(answers, "digest").filter(
        F.col("record_id") != F.col("response.record_id")
    ).select(
        "record_id", F.col("response.record_id").alias("response_id"),
        F.col("response.key").alias("response_key"),
    )


def to_warc(archives: DataFrame, min_bytes: int = 1000) -> DataFrame:
    """``value``: the text of each WARC record, but for the two line ends behind it."""
    narrow = records(archives, payloads=False)
    joined = records(archives).join(revisits(narrow, min_bytes), "record_id", "left")

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = ["record_id", "url", "date", "digest", "response_id", "response_key"]
            columns = [values(batch, n) for n in names]
            out = []
            for rid, url, date, digest, to, to_key, block in zip(
                *columns, utf8(batch, "block"), strict=True
            ):
                head = [
                    "WARC/1.0", f"WARC-Type: {'response' if to is None else 'revisit'}",
                    f"WARC-Record-ID: <urn:uuid:{rid}>", f"WARC-Date: {date}",
                    f"WARC-Target-URI: {url}", f"WARC-Payload-Digest: {digest}",
                ]
                if to is not None:
                    block = _http(block)[0]
                    head += [
                        f"WARC-Refers-To: <urn:uuid:{to}>",
                        f"WARC-Refers-To-Key: {'' if to_key is None else to_key}",
                        "WARC-Profile: http://netpreserve.org/warc/1.0/revisit/identical-payload-digest",
                    ]
                head += [
                    f"WARC-Block-Digest: {_digest(block)}",
                    "Content-Type: application/http; msgtype=response",
                    f"Content-Length: {len(block)}",
                ]
                out.append("\r\n".join(head).encode() + END + block)
            yield pa.RecordBatch.from_arrays(
                [pa.array(out, pa.binary()).cast(pa.string())], names=["value"]
            )

    return joined.mapInArrow(spell, "value string")


def write_warc(warc: DataFrame, folder: str, records_per_file: int = 2000) -> None:
    """Gzipped WARC files below ``folder``."""
    warc.write.options(
        lineSep=END.decode(), compression="gzip", maxRecordsPerFile=records_per_file,
        **{"zlib.compress.level": "BEST_SPEED"},
    ).text(folder)


def read_warc(spark: SparkSession, folder: str) -> DataFrame:
    """record_id, type, key, url, date, digest, bytes, refers_to and refers_to_key of each record.

    ``digest`` is the payload's SHA-1 in lower-case hex: of a response computed from the payload read and
    held against the one declared, of a revisit the one declared.
    """
    fields = (
        "record_id string, type string, key long, url string, date string, digest string, "
        "bytes long, refers_to string, refers_to_key long"
    )
    files = spark.read.format("binaryFile").load(folder).select("path", "content")

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(values(batch, "path"), values(batch, "content"), strict=True):
                content, at, out = gzip.decompress(content), 0, []
                while at < len(content):
                    start = content.index(END, at) + 4
                    head = content[at:start]
                    size = int(_field(head, b"Content-Length"))
                    block = content[start : start + size]
                    if content[start + size : start + size + 4] != END:
                        raise ValueError(f"{path}: the record at byte {at} does not end")
                    at = start + size + 4
                    http, body = _http(block)
                    declared = _field(head, b"WARC-Payload-Digest").decode()
                    kind = _field(head, b"WARC-Type").decode()
                    if kind == "response" and _digest(body) != declared:
                        raise ValueError(f"{path}: digest of the record before byte {at}")
                    to, to_key = _field(head, b"WARC-Refers-To"), _field(head, b"WARC-Refers-To-Key")
                    out.append((
                        _field(head, b"WARC-Record-ID")[10:-1].decode(), kind, _key(http),
                        _field(head, b"WARC-Target-URI").decode(), _field(head, b"WARC-Date").decode(),
                        base64.b32decode(declared[5:]).hex(),
                        len(body) if kind == "response" else int(_field(http, b"Content-Length")),
                        to[10:-1].decode() if to else None, int(to_key) if to_key else None,
                    ))
                if out:
                    columns = list(zip(*out, strict=True))
                    kinds = [pa.int64() if i in (2, 6, 8) else pa.string() for i in range(9)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)],
                        names=[f.split(" ")[0] for f in fields.split(", ")],
                    )

    return files.mapInArrow(parse, fields)
