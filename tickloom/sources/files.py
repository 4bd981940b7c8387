"""Whole files and archive entries as key-value records."""

from __future__ import annotations

import io
import zipfile
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.operators.ordering import with_rank
from tickloom.session import materialise

# Archive entries handed to Spark at once.
_BATCH_BYTES = 32 * 1024 * 1024
_BATCH_ROWS = 10_000


def read_whole_files(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``(path, length, content)`` of files."""
    return spark.read.format("binaryFile").load(path).select("path", "length", "content")


def whole_file_ingest(spark: SparkSession, path_list: DataFrame, folder: str | list[str]) -> DataFrame:
    """``(key, value)`` records for lines of one or two paths.

    A line with one path gives the base name and the bytes of the file; a line
    with two gives the bytes of both. Blank lines are skipped and more paths are
    an error. ``folder`` is where the files are; they are read by Spark and joined
    to the list, and a listed file that is not there is an error.
    """
    tokens = F.split(F.trim("line"), r"\s+")
    too_many = F.raise_error(F.concat(F.lit("not one or two paths: "), F.col("line")))
    listed = path_list.where(F.trim("line") != "").withColumn("tokens", tokens)
    wanted = listed.where(
        F.when(F.size("tokens") <= 2, True).otherwise(too_many.cast("boolean"))
    ).select(
        F.when(F.size("tokens") == 2, _plain_path(F.col("tokens")[0])).alias("key_path"),
        _plain_path(F.element_at("tokens", -1)).alias("value_path"),
    )
    # The list is written, so its size is known and a short list is broadcast:
    # file contents then stay where they are read. Only lines of two paths bring
    # the contents of two files together.
    wanted = materialise(wanted)
    files = read_whole_files(spark, folder).select(_plain_path(F.col("path")).alias("path"), "content")
    _check_listed(wanted, files.select("path"))
    values = files.select(F.col("path").alias("value_path"), F.col("content").alias("value"))
    base_name = F.element_at(F.split("value_path", "/"), -1).cast("binary")
    single = values.join(wanted.where(F.col("key_path").isNull()), "value_path").select(
        base_name.alias("key"), "value"
    )
    keys = files.select(F.col("path").alias("key_path"), F.col("content").alias("key"))
    paired = values.join(wanted.where(F.col("key_path").isNotNull()), "value_path").join(
        keys, "key_path"
    )
    return single.unionByName(paired.select("key", "value"))


def _check_listed(wanted: DataFrame, present: DataFrame) -> None:
    """Fail when a listed path is not among the files."""
    paths = wanted.select(F.col("value_path").alias("path")).union(
        wanted.where(F.col("key_path").isNotNull()).select("key_path")
    )
    missing = paths.join(present, "path", "left_anti").take(3)
    if missing:
        raise FileNotFoundError(f"listed files not found: {', '.join(row['path'] for row in missing)}")


def _plain_path(path: Column) -> Column:
    """A path without its scheme, so that listed and read paths compare."""
    return F.regexp_replace(path, r"^[a-z0-9]+:(?://[^/]*)?(?=/)", "")


def ingest_totals(records: DataFrame) -> DataFrame:
    """Number of records and their total bytes."""
    size = F.octet_length("key") + F.octet_length("value")
    return records.agg(
        F.count(F.lit(1)).alias("n_records"), F.coalesce(F.sum(size), F.lit(0)).alias("total_bytes")
    )


#: Packed bytes of entries that one task reads, but for one larger entry.
SPLIT_BYTES = 128 * 1024 * 1024
# What stands before the bytes of an entry, apart from its name and extra field.
_LOCAL_HEADER = 30
_STORED, _DEFLATED = zipfile.ZIP_STORED, zipfile.ZIP_DEFLATED


def archive_index(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """A row per entry of zip archives: ``path``, ``name``, ``offset``, ``packed``, ``size``, ``method``, ``crc``.

    Only the central directory of an archive is read, by ranges at its end; directories are
    skipped. The archives must be in a store that ``pyarrow.fs`` opens.
    """
    archives = spark.read.format("binaryFile").load(path).select("path")
    schema = "path string, name string, offset long, packed long, size long, method int, crc long"
    fields = [f.split()[0] for f in schema.split(", ")]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for place in batch.column("path").to_pylist():
                with _opened(place) as file, zipfile.ZipFile(_Ranges(file)) as archive:
                    entries = [e for e in archive.infolist() if not e.is_dir()]
                if any(e.flag_bits & 1 for e in entries):
                    raise ValueError(f"encrypted entries in {place}")
                rows = [
                    (place, e.filename, e.header_offset, e.compress_size, e.file_size, e.compress_type, e.CRC)
                    for e in entries
                ]
                for first in range(0, len(rows), _BATCH_ROWS):
                    columns = [pa.array(c) for c in zip(*rows[first : first + _BATCH_ROWS])]
                    columns[fields.index("method")] = columns[fields.index("method")].cast(pa.int32())
                    yield pa.RecordBatch.from_arrays(columns, names=fields)

    # A task per archive at most: what is slow is opening them, not their paths.
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return archives.repartition(n, "path").mapInArrow(read, schema)


def read_archive_entries(spark: SparkSession, path: str | list[str], split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """``(key, value)`` of every entry of zip archives of any size; keys are those of ``archive_entries``.

    The index is dealt out by packed bytes, so a large archive is read by many tasks, each by
    ranges of its own; no archive is held whole. Entries are stored or deflated, and their
    checksums are checked. A single entry is a single value and must fit a task.
    """
    index = archive_index(spark, path).withColumn("_all", F.lit(0))
    order = [F.col("path"), F.col("offset")]
    dealt = with_rank(index, ["_all"], order, "_place", F.col("packed") + _LOCAL_HEADER, "_before")
    part = F.floor(F.col("_before") / split_bytes)
    tasks = dealt.withColumn("part", part).drop("_all", "_place", "_before")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return (
        tasks.repartition(n, "part").sortWithinPartitions("path", "offset").mapInArrow(_read_entries, "key string, value binary")
    )


def _read_entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    opened, file = None, None
    keys: list[str] = []
    values: list[bytes] = []
    held = 0
    for batch in batches:
        for entry in batch.to_pylist():
            if entry["path"] != opened:
                if file is not None:
                    file.close()
                opened, file = entry["path"], _opened(entry["path"])
            keys.append(f"{_archive_name(opened)} {entry['name']}")
            values.append(_entry(file, entry))
            held += len(values[-1])
            if held >= _BATCH_BYTES or len(keys) >= _BATCH_ROWS:
                yield _records(keys, values)
                keys, values, held = [], [], 0
    if file is not None:
        file.close()
    if keys:
        yield _records(keys, values)


def _opened(path: str) -> pa.NativeFile:
    """A file by the path that Spark gives it, which is not percent-encoded."""
    if path.startswith("file:"):
        return fs.LocalFileSystem().open_input_file("/" + path.removeprefix("file:").lstrip("/"))
    system, inner = fs.FileSystem.from_uri(quote(path, safe=":/@"))
    return system.open_input_file(inner)


class _Ranges(io.RawIOBase):
    """A file read by ranges, which fails as files do where it is asked for a place before its start."""

    def __init__(self, file: pa.NativeFile):
        self.file, self.size, self.place = file, file.size(), 0

    def readable(self) -> bool:
        return True

    def seekable(self) -> bool:
        return True

    def seek(self, offset: int, whence: int = io.SEEK_SET) -> int:
        place = offset + {io.SEEK_SET: 0, io.SEEK_CUR: self.place, io.SEEK_END: self.size}[whence]
        if place < 0:
            raise OSError("before the start of the file")
        self.place = place
        return place

    def readinto(self, buffer) -> int:
        data = self.file.read_at(min(len(buffer), max(0, self.size - self.place)), self.place)
        buffer[: len(data)] = data
        self.place += len(data)
        return len(data)


def _records(keys: list[str], values: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(keys), pa.array(values, pa.binary())], names=["key", "value"])


def _entry(file: pa.NativeFile, entry: dict) -> bytes:
    header = file.read_at(_LOCAL_HEADER, entry["offset"])
    # Lengths of the name and of the extra field, as the local header has them.
    skipped = sum(int.from_bytes(header[i : i + 2], "little") for i in (26, 28))
    packed = file.read_at(entry["packed"], entry["offset"] + _LOCAL_HEADER + skipped)
    if entry["method"] == _STORED:
        value = packed
    elif entry["method"] == _DEFLATED:
        value = zlib.decompress(packed, -zlib.MAX_WBITS)
    else:
        raise ValueError(f"entry {entry['name']} is packed by method {entry['method']}")
    if len(value) != entry["size"] or zlib.crc32(value) != entry["crc"]:
        raise ValueError(f"entry {entry['name']} of {entry['path']} is damaged")
    return value


def _archive_name(path: str) -> str:
    return quote(path.rsplit("/", 1)[-1], safe="*-._").replace("~", "%7E")


def archive_entries(archives: DataFrame) -> DataFrame:
    """``(key, value)`` of every entry of zip archives, directories skipped.

    ``archives`` has ``path`` and ``content``. A key is the archive's base name,
    percent-encoded, a space and the entry name.
    """

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        keys: list[str] = []
        values: list[bytes] = []
        held = 0
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"]):
                name = _archive_name(path)
                with zipfile.ZipFile(io.BytesIO(content)) as archive:
                    for entry in archive.infolist():
                        if entry.is_dir():
                            continue
                        keys.append(f"{name} {entry.filename}")
                        values.append(archive.read(entry))
                        held += len(values[-1])
                        if held >= _BATCH_BYTES or len(keys) >= _BATCH_ROWS:
                            yield pd.DataFrame({"key": keys, "value": values})
                            keys, values, held = [], [], 0
        if keys:
            yield pd.DataFrame({"key": keys, "value": values})

    return archives.select("path", "content").mapInPandas(read, "key string, value binary")
