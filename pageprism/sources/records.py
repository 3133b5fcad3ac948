"""Archived records: gzip members inside large archive files, located by file, offset and length.

Locators are range-partitioned by (file, offset), so each task reads neighbouring members of few files in
order, and a file that holds a large share of all records is split by offset. Files are opened through
the file system their URI names, so tasks read the ranges they need wherever the archive lies.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator
from itertools import groupby

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pageprism import schemas
from pageprism.functions.charset import with_text
from pageprism.session import checkpointed, shared_folder
from pageprism.sources.archive import file_system, record_parts

#: Records that lie this near each other are read at once, up to so many bytes.
GAP_BYTES = 128 << 10
READ_BYTES = 8 << 20
BATCH_BYTES = 32 << 20
BLANKS = " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0"


def inflate(data: bytes) -> bytes:
    try:
        return zlib.decompress(data, wbits=zlib.MAX_WBITS | 16)
    except zlib.error:
        return b""


def merged_reads(spans: list[tuple[int, int]], gap: int = GAP_BYTES, most: int = READ_BYTES) -> Iterator[tuple[int, int, int, int]]:
    """Reads (first, last, start, end) for the spans (offset, length), which are in order: spans ``first`` to ``last`` - 1 lie in the bytes
    ``start`` to ``end``."""
    first, end = 0, -1
    for i, (offset, length) in enumerate(spans):
        start = spans[first][0]
        if i > first and (offset - end > gap or max(end, offset + length) - start > most):
            yield first, i, start, end
            first, end = i, -1
        end = max(end, offset + length)
    if spans:
        yield first, len(spans), spans[first][0], end


def fetch_records(locators: DataFrame, root: str, partitions: int | None = None, missing: str = "error") -> DataFrame:
    """Index rows with ``response`` (text, decoded by the charset rules) and ``header`` added.

    Locators are dealt by ranges of (file, offset), and neighbouring records are read at once. A record that can't be inflated
    keeps its row, with nulls. A file that isn't there ends the query, unless ``missing`` is ``"null"``: then its rows have
    nulls too.
    """
    keys = [F.col("warc_filename"), F.col("warc_record_offset")]
    placed = (locators.repartitionByRange(partitions, *keys) if partitions
              else locators.repartitionByRange(*keys)).sortWithinPartitions(*keys)
    schema = T.StructType([*locators.schema.fields, T.StructField("_body", T.BinaryType()), T.StructField("header", T.StringType())])
    names = [*locators.columns, "_body", "header"]
    at = [locators.columns.index(c) for c in ("warc_filename", "warc_record_offset", "warc_record_length")]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = file_system(root)
        for batch in batches:
            files, offsets, lengths = (batch.column(i).to_pylist() for i in at)
            for name, rows in groupby(range(len(files)), lambda i: files[i]):
                rows = list(rows)
                try:
                    handle = None if name is None else system.open_input_file(f"{base.rstrip('/')}/{name}")
                except FileNotFoundError:
                    if missing == "error":
                        raise
                    handle = None
                for first, last, contents in _contents(handle, [(offsets[i], lengths[i]) for i in rows]):
                    parts = [record_parts(c)[1:] if c else (None, None) for c in contents]
                    parts = [(h, b) if h and b else (None, None) for h, b in parts]
                    yield pa.RecordBatch.from_arrays([
                        *batch.slice(rows[first], last - first).columns, pa.array([b for _, b in parts], pa.binary()),
                        pa.array([h for h, _ in parts], pa.string())], names=names)
                if handle is not None:
                    handle.close()

    found = with_text(placed.mapInArrow(read, schema), "_body", "response", "header")
    found = found.withColumn("response", F.nullif(F.rtrim("response", F.lit(BLANKS)), F.lit("")))
    return found.select(*locators.columns, "response", F.when(F.col("response").isNotNull(), F.col("header")).alias("header"))


def _contents(handle, spans: list[tuple[int | None, int | None]]) -> Iterator[tuple[int, int, list[bytes]]]:
    """(first, last, inflated records) of neighbouring spans, in groups of bounded size. Spans without a place are empty."""
    if handle is None or any(o is None or n is None for o, n in spans):
        if handle is None or all(o is None or n is None for o, n in spans):
            yield 0, len(spans), [b""] * len(spans)
            return
        for i, span in enumerate(spans):
            for _, _, got in _contents(None if None in span else handle, [span]):
                yield i, i + 1, got
        return
    for first, last, start, end in merged_reads(spans):
        data = handle.read_at(end - start, start)
        begin, held, size = first, [], 0
        for i in range(first, last):
            offset, length = spans[i]
            held.append(inflate(data[offset - start:offset - start + length]))
            size += len(held[-1])
            if size > BATCH_BYTES:
                yield begin, i + 1, held
                begin, held, size = i + 1, [], 0
        if held:
            yield begin, last, held


def write_records(pages: DataFrame, root: str | None = None) -> tuple[DataFrame, str]:
    """Writes ``domain, crawl, url_path, header, response`` (text or bytes) as archive files, one per task.

    Returns the locators, stored, and the folder. File names are unique per attempt, so a task
    that runs twice leaves an unused file instead of a broken one.
    """
    if root is None:
        root = f"{shared_folder(pages.sparkSession).rstrip('/')}/pageprism/records-{uuid.uuid4().hex}"
    schema = schemas.PAGE_INDEX

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, base = file_system(root)
        system.create_dir(base, recursive=True)
        name = f"{uuid.uuid4().hex}.warc.gz"
        with system.open_output_stream(f"{base}/{name}", compression=None) as out:
            position = 0
            for batch in batches:
                offsets, lengths = [], []
                for domain, path, header, body in zip(batch["domain"], batch["url_path"], batch["header"],
                                                      batch["response"]):
                    body = body.encode() if isinstance(body, str) else body or b""
                    block = (header or "").encode() + b"\r\n\r\n" + body
                    archive = (f"WARC/1.0\r\nWARC-Type: response\r\nWARC-Target-URI: https://{domain}{path}\r\n"
                               f"Content-Length: {len(block)}\r\n\r\n")
                    record = archive.encode() + block + b"\r\n\r\n"
                    packer = zlib.compressobj(wbits=zlib.MAX_WBITS | 16)
                    member = packer.compress(record) + packer.flush()
                    out.write(member)
                    offsets.append(position)
                    lengths.append(len(member))
                    position += len(member)
                yield batch[["domain", "crawl", "url_path"]].assign(
                    warc_filename=name, warc_record_offset=offsets, warc_record_length=lengths)

    wanted = pages.select("domain", "crawl", "url_path", "header", "response")
    return checkpointed(wanted.mapInPandas(write, T.StructType(schema.fields))), root
