"""WARC archives of pages with a two-level capture index.

Method. Pages are written as WARC records, one gzip member each. The index has
a line per record, sorted by the reversed-host key of its URL; runs of lines are
compressed into blocks, and a sparse directory has the first key and the place
of each block. A lookup searches the directory by bisection, reads the blocks of
a key by range and then the records by range.

Archives, index files and their directories are files in the shared folder. A
task writes files of its own under new names, and only what a finished task
reported is ever read, so a repeated task leaves unread files at worst.
"""

from __future__ import annotations

import base64
import bisect
import gzip
import hashlib
import json
import uuid
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from urllib.parse import quote, urlsplit

import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.session import materialise, new_shared_path

ARCHIVE_BYTES = 1 << 30
#: Lines per compressed block of the index.
BLOCK_LINES = 500
#: Records are read back in runs of so many bytes of an archive.
READ_BYTES = 16 << 20
#: The pages carry no time of capture.
CAPTURED = "1970-01-01T00:00:00Z"

_PAGE = "urn:x-page:"
_REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

_CAPTURES = "key string, page_id long, archive string, offset long, length long"
_BLOCKS = "index_file string, first_key string, last_key string"
_RECORDS = (
    "page_id long, payload_bytes long, payload_digest string, record_type string, "
    "refers_to long, url string"
)


def surt(url: str | None) -> str:
    """Reversed-host key: ``http://www.a.org:8/b?c#d`` is ``org,a,www:8)/b?c``; null is empty."""
    if url is None:
        return ""
    safe = "%/:?#[]@!$&'()*+,;=~"
    try:
        parts = urlsplit(url.strip())
        host, port = parts.hostname or "", parts.port
    except ValueError:
        return quote(url, safe=safe)
    if not host:
        return quote(url, safe=safe)
    key = ",".join(reversed(host.split("."))) + (f":{port}" if port else "")
    return quote(f"{key}){parts.path or '/'}" + (f"?{parts.query}" if parts.query else ""), safe=safe)


@F.pandas_udf(T.StringType())
def surt_key(urls: pd.Series) -> pd.Series:
    return urls.map(surt)


def digest_text(sha1: bytes) -> str:
    return base64.b32encode(sha1).decode()


def _record(page: int | None, url: str | None, payload: bytes, sha1: bytes, first: int | None) -> bytes:
    revisit = first is not None and page != first
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if revisit else http + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <{_PAGE}{'' if page is None else page}>",
        f"WARC-Date: {CAPTURED}",
        *([] if url is None else ["WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A")]),
        f"WARC-Payload-Digest: sha1:{digest_text(sha1)}",
        *([f"WARC-Profile: {_REVISIT}", f"WARC-Refers-To: <{_PAGE}{first}>"] if revisit else []),
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
        "",
        "",
    ]
    return gzip.compress("\r\n".join(lines).encode() + block + b"\r\n\r\n", 6, mtime=0)


def _page_number(value: str | None) -> int | None:
    number = (value or "").strip("<>").removeprefix(_PAGE)
    return int(number) if number else None


def parse_record(member: bytes) -> tuple[int | None, int, str, str, int | None, str | None]:
    """A row of ``_RECORDS`` from one gzip member."""
    head, _, rest = gzip.decompress(member).partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(http.rpartition(b"Content-Length: ")[2])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if fields["WARC-Type"] == "response" and (
        len(payload) != size or digest_text(hashlib.sha1(payload).digest()) != digest
    ):
        raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
    return (
        _page_number(fields["WARC-Record-ID"]),
        size,
        digest,
        fields["WARC-Type"],
        _page_number(fields.get("WARC-Refers-To")),
        fields.get("WARC-Target-URI"),
    )


def _open_folder(uri: str) -> tuple[fs.FileSystem, str]:
    system, path = fs.FileSystem.from_uri(uri)
    system.create_dir(path, recursive=True)
    return system, path


def _table(schema: str, rows: list[tuple]) -> pa.RecordBatch:
    fields = [f.split() for f in schema.split(", ")]
    kinds = {"long": pa.int64(), "string": pa.string()}
    columns = list(zip(*rows, strict=True)) if rows else [[] for _ in fields]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, kinds[kind]) for c, (_, kind) in zip(columns, fields, strict=True)],
        names=[name for name, _ in fields],
    )


class _Archive:
    """The archive a task is writing."""

    def __init__(self, folder: str):
        self.system, path = _open_folder(folder)
        self.path = f"{path}/{uuid.uuid4().hex}.warc.gz"
        self.stream = self.system.open_output_stream(self.path, compression=None)
        self.size = 0
        about = [
            "WARC/1.1",
            "WARC-Type: warcinfo",
            f"WARC-Record-ID: <urn:uuid:{uuid.uuid4()}>",
            f"WARC-Date: {CAPTURED}",
            "Content-Type: application/warc-fields",
            "Content-Length: 0",
        ]
        self.add(gzip.compress("\r\n".join([*about, *[""] * 4]).encode(), mtime=0))

    def add(self, member: bytes) -> tuple[str, int, int]:
        self.stream.write(member)
        self.size += len(member)
        return self.path, self.size - len(member), len(member)


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Write a record per row of ``pages``; returns a capture per record, written to the shared folder.

    Of records with equal payloads the one with the smallest ``page_id`` is a
    response, the others are revisits of it. Rows that repeat the smallest id
    are all responses; a null id is never the smallest, and payloads that only
    have null ids are responses. A null ``html`` is an empty payload, a null
    ``url`` has the empty key. Other columns are not read.
    """
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    known = pages.select("page_id", "url", payload.alias("payload")).withColumn("sha1", F.unhex(F.sha1("payload")))
    firsts = materialise(
        known.groupBy("sha1").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    ).withColumnRenamed("sha1", "of")
    ready = known.join(firsts, F.col("sha1") == F.col("of"), "left").drop("of")
    return materialise(ready.mapInArrow(_archive_writer(folder), _CAPTURES))


def _archive_writer(folder: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        archive = None
        for batch in batches:
            rows = []
            columns = (batch.column(n).to_pylist() for n in ("page_id", "url", "payload", "sha1", "first"))
            for page, url, payload, sha1, first in zip(*columns, strict=True):
                if archive is None or archive.size >= ARCHIVE_BYTES:
                    if archive is not None:
                        archive.stream.close()
                    archive = _Archive(folder)
                rows.append((surt(url), page, *archive.add(_record(page, url, payload, sha1, first))))
            yield _table(_CAPTURES, rows)
        if archive is not None:
            archive.stream.close()

    return run


@dataclass
class CaptureIndex:
    """A sorted index: one entry per index file with its first and last key.

    A file holds one range of keys. The entries stay on the driver; there is
    one per partition of the sort, however many captures there are.
    """

    folder: str
    files: list[tuple[str, str, str]]

    def files_of(self, key: str) -> list[str]:
        after = bisect.bisect_right([f[1] for f in self.files], key)
        return [f[0] for f in self.files[:after] if f[2] >= key]


def build_index(captures: DataFrame, folder: str, block_lines: int = BLOCK_LINES) -> CaptureIndex:
    """Sort captures into files of compressed blocks, each file with the directory of its blocks.

    Captures of one key are ordered by place, and a key with very many captures
    spreads over several files.
    """
    order = ["key", "archive", "offset"]
    n = int(captures.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    written = materialise(
        captures.repartitionByRange(n, *order)
        .sortWithinPartitions(*order)
        .mapInArrow(_index_writer(folder, block_lines), _BLOCKS)
    )
    files = [tuple(r) for r in written.orderBy("first_key", "last_key", "index_file").collect()]
    return CaptureIndex(folder, files)


def _index_writer(
    folder: str, block_lines: int
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """File: blocks, then the directory as JSON, then eight bytes with the directory's length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        directory, lines, place = [], [], 0
        system, path = fs.FileSystem.from_uri(folder)
        stream = None
        name = f"{path}/{uuid.uuid4().hex}.cdx"

        def close_block() -> None:
            nonlocal place
            data = zlib.compress("\n".join(json.dumps(x) for x in lines).encode())
            stream.write(data)
            directory.append((lines[0][0], place, len(data)))
            place += len(data)

        last = None
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if stream is None:
                    stream = _open_folder(folder)[0].open_output_stream(name, compression=None)
                lines.append(row)
                last = row[0]
                if len(lines) == block_lines:
                    close_block()
                    lines = []
        if lines:
            close_block()
        if stream is not None:
            data = zlib.compress(json.dumps(directory).encode())
            stream.write(data + len(data).to_bytes(8, "little"))
            stream.close()
            yield _table(_BLOCKS, [(name, directory[0][0], last)])

    return run


def _blocks_of(directory: list[list], firsts: list[str], key: str) -> list[tuple[int, int]]:
    """Places of the blocks that can hold a key, by bisection of the first keys."""
    begin = max(0, bisect.bisect_left(firsts, key) - 1)
    return [(place, size) for _, place, size in directory[begin : bisect.bisect_right(firsts, key)]]


def look_up(index: CaptureIndex, keys: DataFrame) -> DataFrame:
    """The captures of each distinct ``key`` of ``keys``."""
    session = keys.sparkSession
    held = session.sparkContext.broadcast(index)

    @F.pandas_udf(T.ArrayType(T.StringType()))
    def files_of(wanted: pd.Series) -> pd.Series:
        return wanted.map(held.value.files_of)

    placed = keys.select("key").distinct().select(F.explode(files_of("key")).alias("file"), "key")
    n = int(session.conf.get("spark.sql.shuffle.partitions"))
    return (
        placed.repartition(n, "file")
        .sortWithinPartitions("file", "key")
        .mapInArrow(_finder(index.folder), _CAPTURES)
    )


def _finder(folder: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, _ = fs.FileSystem.from_uri(folder)
        opened, source, directory, firsts, kept = None, None, [], [], {}
        for batch in batches:
            found = []
            for file, key in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if file != opened:
                    opened, kept = file, {}
                    source = system.open_input_file(file)
                    end = source.size()
                    size = int.from_bytes(source.read_at(8, end - 8), "little")
                    directory = json.loads(zlib.decompress(source.read_at(size, end - 8 - size)))
                    firsts = [d[0] for d in directory]
                for place, size in _blocks_of(directory, firsts, key):
                    if place not in kept:
                        # Keys come in order, so that the block before may still be wanted.
                        kept = {k: v for k, v in list(kept.items())[-1:]}
                        kept[place] = _lines(zlib.decompress(source.read_at(size, place)))
                    found.extend(kept[place].get(key, []))
                    if len(found) >= 10_000:
                        yield _table(_CAPTURES, found)
                        found = []
            yield _table(_CAPTURES, found)

    return run


def _lines(block: bytes) -> dict[str, list[tuple]]:
    by_key: dict[str, list[tuple]] = {}
    for line in block.decode().split("\n"):
        row = json.loads(line)
        by_key.setdefault(row[0], []).append(tuple(row))
    return by_key


def read_records(captures: DataFrame, folder: str) -> DataFrame:
    """The records of some captures, read by range and checked against their digests."""
    n = int(captures.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    run = F.floor(F.col("offset") / READ_BYTES).alias("run")
    return (
        captures.select("archive", run, "offset", "length")
        .repartition(n, "archive", "run")
        .sortWithinPartitions("archive", "offset")
        .mapInArrow(_reader(folder), _RECORDS)
    )


def _reader(folder: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, _ = fs.FileSystem.from_uri(folder)
        opened, source = None, None
        for batch in batches:
            rows = []
            columns = (batch.column(n).to_pylist() for n in ("archive", "offset", "length"))
            for archive, offset, length in zip(*columns, strict=True):
                if archive != opened:
                    opened, source = archive, system.open_input_file(archive)
                rows.append(parse_record(source.read_at(length, offset)))
            yield _table(_RECORDS, rows)

    return run


def archive_and_read(pages: DataFrame, block_lines: int = BLOCK_LINES) -> DataFrame:
    """Write ``pages`` as archives, index them, look up every URL and read its records.

    A row per row of ``pages``: ``page_id``, ``payload_bytes``,
    ``payload_digest`` (base32 SHA-1), ``record_type``, ``refers_to``, ``url``.
    An empty table gives no rows.
    """
    folder = new_shared_path(pages.sparkSession, "warc")
    captures = write_archives(pages, folder)
    index = build_index(captures, folder, block_lines)
    wanted = pages.select(surt_key(F.col("url")).alias("key"))
    return read_records(look_up(index, wanted), folder)
