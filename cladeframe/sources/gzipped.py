"""Gzip files read by their members in parallel, and written so that they can be.

A gzip file may be several compressed streams, its members, one after the other, as block
compressors, parallel ones and joined files leave them. This data source of Spark cuts files into
ranges of bytes; a task looks for the first member that begins in its range and reads all that
do, so that a file takes as many tasks as it has members and ranges. A file of one member is
read by one task: spread its rows by repartition() after the read.
"""

from __future__ import annotations

import json
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

RANGE = 64 << 20  # compressed bytes of a range
MEMBER = 4 << 20  # bytes of text of a written member
CHUNK = 1 << 18  # bytes read, and inflated, at a time
PROBE = 1 << 20  # compressed bytes that must inflate before a place in a file is taken for a member
ROWS, BYTES = 1000, 4 << 20  # of a batch handed to Spark
MAGIC = b"\x1f\x8b\x08"  # fixed value: how a member begins


def _place(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path) if re.match(r"[a-z][a-z0-9+.-]*:", path) else (pafs.LocalFileSystem(), path)


def _files(path: str) -> list[pafs.FileInfo]:
    """The file, or those of the folder, without hidden ones."""
    fs, at = _place(path)
    info = fs.get_file_info(at)
    if info.type == pafs.FileType.NotFound:
        raise FileNotFoundError(path)
    if info.type == pafs.FileType.File:
        return [info]
    inner = fs.get_file_info(pafs.FileSelector(at))
    return sorted((x for x in inner if x.type == pafs.FileType.File and x.base_name[0] not in "._"), key=lambda x: x.path)


def _is_member(f, at: int) -> bool:
    """Whether what begins there inflates for PROBE bytes, or to its end with the right checksum and
    then the file's end, zeros or another member. One that the file's end cuts off counts."""
    f.seek(at)
    inflate, seen = zlib.decompressobj(31), 0
    try:
        while seen < PROBE:
            data = f.read(CHUNK)
            if not data:
                return True
            seen += len(data)
            while data and not inflate.eof:
                inflate.decompress(data, CHUNK)
                data = inflate.unconsumed_tail
            if inflate.eof:
                after = (inflate.unused_data[:3] + f.read(3))[:3]
                return after == MAGIC or not after.strip(b"\0")
    except zlib.error:
        return False
    return True


def first_member(f, start: int, stop: int) -> int | None:
    """Where the first member in a range of bytes begins."""
    if start == 0:
        return 0
    for at in range(start, stop, CHUNK):
        f.seek(at)
        data = f.read(min(CHUNK, stop - at) + 3)  # a mark of four bytes may go on in the next chunk
        for found in re.finditer(rb"(?s)\x1f\x8b\x08(?=[\x00-\x1f])", data):
            if _is_member(f, at + found.start()):
                return at + found.start()
    return None


def inflated(f, start: int, stop: int) -> Iterator[tuple[bytes, bool]]:
    """(bytes, whether their member begins before stop) of all members from start on.

    Zeros between members are skipped. A member that is cut off raises EOFError, a wrong checksum
    zlib.error, other bytes between members ValueError."""
    f.seek(start)
    data, at = b"", start
    while True:
        inflate, own = zlib.decompressobj(31), at < stop
        while not inflate.eof:
            data = data or f.read(CHUNK)
            out = inflate.decompress(data, CHUNK)
            if not data and not out and not inflate.eof:
                raise EOFError(f"the member ends too early at byte {at}")
            rest = inflate.unused_data if inflate.eof else inflate.unconsumed_tail
            at, data = at + len(data) - len(rest), rest
            if out:
                yield out, own
        while not (kept := data.lstrip(b"\0")):
            at, data = at + len(data), f.read(CHUNK)
            if not data:
                return
        at, data = at + len(data) - len(kept), kept
        if len(data) < len(MAGIC):
            data += f.read(CHUNK)
        if not data.startswith(MAGIC):
            raise ValueError(f"no gzip member at byte {at}")


def records(pieces: Iterator[tuple[bytes, bool]], sep: bytes, begins: bool) -> Iterator[tuple[bytes, bool]]:
    """(record, whether it is the file's first): those after a separator that begins in own pieces.

    begins: the pieces are a file's first. A record goes on into pieces that aren't own; nothing
    after the last separator is no record."""
    held, scan, edge = bytearray(), 0, None  # edge: where bytes that aren't own begin
    within, first = begins, begins
    for piece, own in pieces:
        if not own and edge is None:
            edge = len(held)
        held += piece
        done = 0
        while (at := held.find(sep, scan)) >= 0:
            if within:
                yield bytes(held[done:at]), first
            first, within = False, edge is None or at < edge
            if not within:
                return
            done = scan = at + len(sep)
        scan = max(scan, len(held) - len(sep) + 1)
        if not within:
            if edge is not None and scan >= edge:
                return
            done = scan
        del held[:done]
        scan, edge = scan - done, None if edge is None else edge - done
    if within and held:
        yield bytes(held), first


@dataclass
class Range(InputPartition):
    path: str
    start: int
    stop: int


class _Reader(DataSourceReader):
    def __init__(self, options: dict[str, str]) -> None:
        self.paths, self.sep, self.range = json.loads(options["paths"]), json.loads(options["sep"]).encode(), int(options["range"])

    def partitions(self) -> list[Range]:
        found = [(path, x) for path in self.paths for x in _files(path)]
        return [Range(_whole(path, x.path), at, min(at + self.range, x.size)) for path, x in found for at in range(0, x.size, self.range)] or [Range("", 0, 0)]

    def read(self, part: Range) -> Iterator[pa.RecordBatch]:
        if part.start == part.stop:
            return
        fs, at = _place(part.path)
        values, marks, size = [], [], 0
        with fs.open_input_file(at) as f:
            start = first_member(f, part.start, part.stop)
            if start is None:
                return
            for value, first in records(inflated(f, start, part.stop), self.sep, start == 0):
                values.append(value.decode("utf-8", "replace"))
                marks.append(first)
                size += len(value)
                if len(values) == ROWS or size >= BYTES:
                    yield _batch(values, part.path, marks)
                    values, marks, size = [], [], 0
        if values:
            yield _batch(values, part.path, marks)


def _whole(given: str, path: str) -> str:
    """A path as the file system has it, with the scheme that was given."""
    scheme = re.match(r"([a-z][a-z0-9+.-]*:)(//[^/]*)?", given)
    if not scheme:
        return path
    host = scheme[2] or ""
    return scheme[1] + (host if path.startswith("/") else "//") + path


def _batch(values: list[str], path: str, marks: list[bool]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(values, pa.string()), pa.array([path] * len(values), pa.string()), pa.array(marks, pa.bool_())], ["value", "path", "first"])


@dataclass
class Written(WriterCommitMessage):
    name: str


class _Writer(DataSourceArrowWriter):
    """Each task writes a hidden file; those of the tasks that Spark commits get their names."""

    def __init__(self, options: dict[str, str], overwrite: bool) -> None:
        self.path, self.sep, self.member, self.overwrite = options["path"], json.loads(options["sep"]).encode(), int(options["member"]), overwrite

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        fs, at = _place(self.path)
        fs.create_dir(at, recursive=True)
        name = f"part-{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex}.gz"
        held, size = [], 0
        with fs.open_output_stream(f"{at}/_{name}", compression=None) as f:
            for batch in iterator:
                for value in batch.column(0).to_pylist():
                    if value is not None:
                        held.append(value.encode() + self.sep)
                        size += len(held[-1])
                    if size >= self.member:
                        f.write(_member(held))
                        held, size = [], 0
            if held:
                f.write(_member(held))
        return Written(name)

    def commit(self, messages: list[Written]) -> None:
        fs, at = _place(self.path)
        fs.create_dir(at, recursive=True)
        if self.overwrite:
            for x in _files(self.path):
                fs.delete_file(x.path)
        for m in messages:
            if m is not None:
                fs.move(f"{at}/_{m.name}", f"{at}/{m.name}")
        fs.open_output_stream(f"{at}/_SUCCESS").close()

    def abort(self, messages: list[Written]) -> None:
        fs, at = _place(self.path)
        for m in messages:
            if m is not None and fs.get_file_info(f"{at}/_{m.name}").type == pafs.FileType.File:
                fs.delete_file(f"{at}/_{m.name}")


def _member(held: list[bytes]) -> bytes:
    deflate = zlib.compressobj(6, zlib.DEFLATED, 31)
    return deflate.compress(b"".join(held)) + deflate.flush()


class GzipRecords(DataSource):
    """Options: paths (JSON list) or path, sep (JSON string), range, member."""

    @classmethod
    def name(cls) -> str:
        return "gzip_records"

    def schema(self) -> str:
        return "value string, path string, first boolean"

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options)

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        return _Writer(self.options, overwrite)


def read_gzip_records(spark: SparkSession, paths: str | list[str], sep: str = "\n", range_bytes: int = RANGE) -> DataFrame:
    """value, path, first (of its file): the records of gzip files, or of folders of them.

    Records end in sep and may go on in the next member. An empty record between two separators is
    a row; empty files have none. Bytes that aren't UTF-8 become U+FFFD. Broken files raise.
    Limits: a separator that overlaps itself (a//a//a) is matched from where a task begins; a
    member that stores whole gzip files uncompressed may be cut within, which mostly raises:
    read such files with a range_bytes beyond their size.
    """
    spark.dataSource.register(GzipRecords)
    given = [paths] if isinstance(paths, str) else list(paths)
    return spark.read.format("gzip_records").option("paths", json.dumps(given)).option("sep", json.dumps(sep)).option("range", range_bytes).load()


def write_gzip_records(df: DataFrame, path: str, sep: str = "\n", member_bytes: int = MEMBER, overwrite: bool = False) -> None:
    """The column value as gzip files of members of whole records, a file per task; nulls are left out.

    Tasks that are run again leave nothing that readers see. overwrite takes earlier files away."""
    df.sparkSession.dataSource.register(GzipRecords)
    rows = df.select("value").write.format("gzip_records").mode("overwrite" if overwrite else "append")
    rows.option("path", path).option("sep", json.dumps(sep)).option("member", member_bytes).save()
