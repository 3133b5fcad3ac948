"""Archive files as a data source of Spark: all members of gzip-compressed web archives, found without an index.

    register(spark)
    spark.read.format("pageprism-archive").load("s3://bucket/crawl")

A partition is a run of byte ranges: large files are cut, small ones are read together. A range holds the members that begin in it. The first one is
found by looking for the mark of a gzip member whose content begins as a record does, so no list of offsets is needed and a large file is read by many tasks.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

FORMAT = "pageprism-archive"
RECORD_SCHEMA = "file string, offset long, length long, type string, target_uri string, date string, header string, body binary"
SPLIT_BYTES = 64 << 20
FILE_COST = 1 << 20
READ_BYTES = 4 << 20
FEED_BYTES = 64 << 10
BATCH_BYTES = 8 << 20
_MEMBER = b"\x1f\x8b\x08"
_FIRST = b"WARC/"
_LENGTH = re.compile(rb"(?im)^content-length\s*:\s*(\d+)")


def file_system(root: str):
    """File system and path of a URI or path, as tasks reach it."""
    from pyarrow import fs

    if "://" in root or root.startswith("file:"):
        return fs.FileSystem.from_uri(root)
    return fs.LocalFileSystem(), root


def text_of(data: bytes) -> str:
    """Header bytes as text: UTF-8, else Latin-1."""
    try:
        return data.decode("utf-8")
    except UnicodeDecodeError:
        return data.decode("latin-1")


def record_parts(data: bytes) -> tuple[dict[str, str], str | None, bytes | None]:
    """Fields of the archive header (names in small letters), HTTP header and body of an inflated member. A record that is no HTTP message
    has a body alone; parts that are missing are null."""
    head, _, rest = data.lstrip().partition(b"\r\n\r\n")
    fields = {}
    for line in text_of(head).split("\r\n")[1:]:
        name, _, value = line.partition(":")
        fields[name.strip().lower()] = value.strip()
    length = _LENGTH.search(head)
    block = rest[:int(length[1])] if length else rest.removesuffix(b"\r\n\r\n")
    if fields.get("warc-type", "response") not in ("response", "request", "revisit"):
        return fields, None, block or None
    header, _, body = block.partition(b"\r\n\r\n")
    return fields, text_of(header) if header else None, body or None


@dataclass
class ArchiveRange(InputPartition):
    """Byte ranges (file, start, end) that one task reads."""

    ranges: tuple

    def __init__(self, ranges):
        super().__init__(0)
        self.ranges = tuple(ranges)


def plan_ranges(files: Sequence[tuple[str, int]], split_bytes: int, file_cost: int = FILE_COST) -> list[tuple]:
    """Runs of ranges of about ``split_bytes`` each, in the order of the files. Opening a file counts as ``file_cost`` bytes."""
    runs, held, size = [], [], 0
    for name, length in files:
        for start in range(0, length, split_bytes):
            end = min(length, start + split_bytes)
            if held and size + end - start + file_cost > split_bytes:
                runs.append(tuple(held))
                held, size = [], 0
            held.append((name, start, end))
            size += end - start + file_cost
    return runs + ([tuple(held)] if held else [])


class _Bytes:
    """A file read forwards in blocks; ``at`` is the place in the file."""

    def __init__(self, handle, at: int):
        self.handle, self.at, self.block, self.first = handle, at, b"", at

    def fill(self, n: int) -> bytes:
        """The next ``n`` bytes, or what is left of the file; the place stays."""
        begin = self.at - self.first
        if len(self.block) - begin < n:
            self.block, self.first = self.block[begin:] + self.handle.read_at(max(n, READ_BYTES), self.at + len(self.block) - begin), self.at
            begin = 0
        return self.block[begin:begin + n]

    def seek_to(self, mark: bytes, end: int) -> bool:
        """Moves to the next place before ``end`` where ``mark`` begins; False, and to ``end`` or behind, if there is none."""
        while self.at < end and self.fill(len(mark)):
            found = self.block.find(mark, self.at - self.first)
            if found >= 0:
                self.at = self.first + found
                return self.at < end
            self.at = max(self.at + 1, self.first + len(self.block) - len(mark) + 1)
        return False


def first_member(source: _Bytes, end: int) -> bool:
    """Moves to the first member that begins before ``end``; False if there is none."""
    while source.seek_to(_MEMBER, end):
        try:
            if zlib.decompressobj(zlib.MAX_WBITS | 16).decompress(source.fill(FEED_BYTES), 64).lstrip().startswith(_FIRST):
                return True
        except zlib.error:
            pass
        source.at += 1
    return False


def members(handle, start: int, end: int) -> Iterator[tuple[int, int, bytes | None]]:
    """(offset, length, inflated bytes) of the members that begin in a range; null bytes for one that is broken, behind which the next
    whole member follows."""
    source = _Bytes(handle, start)
    found = first_member(source, end)
    while found:
        offset, inflate, parts = source.at, zlib.decompressobj(zlib.MAX_WBITS | 16), []
        try:
            while not inflate.eof:
                fed = source.fill(FEED_BYTES)
                parts.append(inflate.decompress(fed))
                source.at += len(fed) - len(inflate.unused_data)
                if not fed:
                    raise zlib.error("the file ends inside a member")
            yield offset, source.at - offset, b"".join(parts)
            found = source.at < end and (source.fill(len(_MEMBER)) == _MEMBER or first_member(source, end))
        except zlib.error:
            source.at = offset + 1
            found = first_member(source, end)
            yield offset, source.at - offset, None


class ArchiveReader(DataSourceReader):
    def __init__(self, options):
        self.root = options["path"]
        self.split_bytes = int(options.get("splitBytes", SPLIT_BYTES))
        self.kinds = {k.strip() for k in options.get("types", "").split(",") if k.strip()}
        self.permissive = options.get("mode", "FAILFAST").upper() == "PERMISSIVE"

    def partitions(self) -> list[ArchiveRange]:
        """Only names and sizes of files pass the driver."""
        from pyarrow import fs

        system, base = file_system(self.root)
        about = system.get_file_info(base)
        if about.type == fs.FileType.NotFound:
            raise FileNotFoundError(f"no archive at {self.root}")
        found = [about] if about.type == fs.FileType.File else system.get_file_info(fs.FileSelector(base, recursive=True))
        files = sorted((f.path, f.size) for f in found if f.type == fs.FileType.File and f.path.endswith(".gz"))
        return [ArchiveRange(r) for r in plan_ranges(files, self.split_bytes)] or [ArchiveRange(())]

    def read(self, partition: ArchiveRange) -> Iterator[pa.RecordBatch]:
        system, _ = file_system(self.root)
        rows, size = [], 0
        for name, start, end in partition.ranges:
            with system.open_input_file(name) as handle:
                for offset, length, data in members(handle, start, end):
                    if data is None:
                        if not self.permissive:
                            raise ValueError(f"broken member in {name} at {offset}")
                        fields, header, body = {}, None, None
                    else:
                        fields, header, body = record_parts(data)
                    if self.kinds and data is not None and fields.get("warc-type") not in self.kinds:
                        continue
                    rows.append((name, offset, length, fields.get("warc-type"), fields.get("warc-target-uri"), fields.get("warc-date"), header, body))
                    size += len(body or b"") + 256
                    if size > BATCH_BYTES:
                        yield _batch(rows)
                        rows, size = [], 0
        if rows:
            yield _batch(rows)


_ARROW = pa.schema([("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64()), ("type", pa.string()), ("target_uri", pa.string()),
                    ("date", pa.string()), ("header", pa.string()), ("body", pa.binary())])


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(_ARROW)], schema=_ARROW)


class ArchiveSource(DataSource):
    """Options: ``path``; ``types`` (record types to keep, comma-separated; all without it); ``splitBytes``; ``mode``: FAILFAST (a broken member
    ends the query) or PERMISSIVE (it gives a row without content)."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return RECORD_SCHEMA

    def reader(self, schema) -> ArchiveReader:
        return ArchiveReader(self.options)


def read_archive(spark: SparkSession, root: str, **options):
    """All records under a folder or in a file, one row each: ``file, offset, length, type, target_uri, date, header, body``."""
    spark.dataSource.register(ArchiveSource)
    return spark.read.format(FORMAT).options(**options).load(root)
