"""Token ids in length-delimited binary record files, with a separate offset index for shuffled reads.

A data file is a run of records, each of them

    8 bytes  length of the payload, little-endian
    4 bytes  masked CRC-32 of these 8 bytes
    n bytes  payload: doc_id (8 bytes), 1 if there is a doc_id (1 byte), bytes per id (1 byte), the ids
    4 bytes  masked CRC-32 of the payload

The index file beside it holds the position of each record and the data file's length as 8-byte integers. A checksum is masked by
turning it 15 bits to the right and adding a constant, so that a file that holds checksums has useful checksums itself.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pageprism.llm.common import column_bytes, groups_by_bytes, map_batches, table
from pageprism.llm.tokens import default_tokenizer, encoder, tokenizer_text
from pageprism.session import shared_folder

MASK_DELTA = 0xA282EAD8
END_ID = 1
READ_BYTES = 8 << 20
_HEAD = struct.Struct("<QI")
_OWN = struct.Struct("<qBB")
_CRC = struct.Struct("<I")

_MANIFEST = "file string, first_doc long, first_text long, n_docs long, n_ids long"
_READ = "doc_id long, file_start long, n_tokens long, ids binary"


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return (((crc >> 15) | (crc << 17)) + MASK_DELTA) & 0xFFFFFFFF


def record(doc_id: int | None, ids: np.ndarray, width: int) -> bytes:
    payload = _OWN.pack(doc_id or 0, doc_id is not None, width) + ids.astype(f"<u{width}").tobytes()
    head = len(payload).to_bytes(8, "little")
    return b"".join((head, _CRC.pack(masked(head)), payload, _CRC.pack(masked(payload))))


def parse(data: bytes, at: int) -> tuple[int | None, np.ndarray, int]:
    """Record at a position: doc_id, ids, position behind it. Raises if a checksum doesn't hold."""
    length, crc = _HEAD.unpack_from(data, at)
    if masked(data[at:at + 8]) != crc:
        raise ValueError(f"length checksum does not hold at {at}")
    start = at + _HEAD.size
    payload = data[start:start + length]
    if len(payload) < length or masked(payload) != _CRC.unpack_from(data, start + length)[0]:
        raise ValueError(f"payload checksum does not hold at {at}")
    doc_id, known, width = _OWN.unpack_from(payload)
    ids = np.frombuffer(payload, f"<u{width}", offset=_OWN.size)
    return doc_id if known else None, ids, start + length + _CRC.size


def _store(path: str):
    """File system and path of a URI or absolute path, as the executors reach it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path)


def write_records(docs: DataFrame, path: str, tokenizer_path: str | None = None, end_id: int = END_ID) -> DataFrame:
    """Encodes whole texts and writes them under ``path`` in ascending order of doc_id; returns the manifest, one row per
    data file, which is stored under ``path`` too.

    Texts are dealt over the files by ranges of (doc_id, hash of the text) and each task writes files under names of their
    own; only files of the manifest, which Spark commits, count, so a repeated or lost task leaves no double records. Ids
    take two bytes where the vocabulary allows. ``path`` must lie in a file system that pyarrow reaches on the executors.

    A null text is an empty one (end id alone). Null doc_ids come first and are kept. Repeated rows are records of
    their own. Extra columns are left out; an empty table gives an empty manifest.
    """
    spark = docs.sparkSession
    tokenizer = spark.sparkContext.broadcast(tokenizer_text(tokenizer_path or default_tokenizer()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(tokenizer.value)
        width = 2 if coder.tokenizer.get_vocab_size() <= 1 << 16 and end_id < 1 << 16 else 4
        files, folder = _store(path)
        name = f"part-{uuid.uuid4().hex}"
        out, offsets, n_ids, first = None, [0], 0, None
        for batch in batches:
            keys, texts, marks = batch.column(0).to_pylist(), column_bytes(batch.column(1)), batch.column(2)
            for a, b in groups_by_bytes(texts):
                ids, counts = coder.encode(texts[a:b])
                if out is None:
                    files.create_dir(folder, recursive=True)
                    out, first = files.open_output_stream(f"{folder}/{name}.rec"), (keys[a], marks[a].as_py())
                held = []
                for key, own in zip(keys[a:b], np.split(ids, np.cumsum(counts)[:-1])):
                    held.append(record(key, np.append(own, np.uint32(end_id)), width))
                    offsets.append(offsets[-1] + len(held[-1]))
                n_ids += len(ids) + (b - a)
                out.write(b"".join(held))
        if out is not None:
            out.close()
            with files.open_output_stream(f"{folder}/{name}.idx") as index:
                index.write(np.array(offsets, "<i8").tobytes())
            yield pa.RecordBatch.from_pydict({"file": [name], "first_doc": pa.array([first[0]], pa.int64()),
                                              "first_text": pa.array([first[1]], pa.int64()),
                                              "n_docs": [len(offsets) - 1], "n_ids": [n_ids]})

    mark = F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), mark.alias("mark"))
    placed = rows.repartitionByRange("doc_id", "mark").sortWithinPartitions("doc_id", "mark")
    map_batches(placed, run, _MANIFEST).write.mode("overwrite").parquet(f"{path}/manifest")
    return read_manifest(spark, path)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """One row per data file, with ``start``: the ids in all files before it. The window sees one row per file."""
    before = Window.orderBy("first_doc", "first_text", "file").rowsBetween(Window.unboundedPreceding, -1)
    files = spark.read.schema(_MANIFEST).parquet(f"{path}/manifest")
    return files.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0).cast("long")))


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """All records of the files in the manifest: doc_id, start (ids before it), n_tokens, ids (little-endian unsigned
    32-bit). A file is read in pieces along its index; a record whose checksum doesn't hold ends the query."""
    manifest = read_manifest(spark, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, folder = _store(path)
        for batch in batches:
            for name, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                with files.open_input_file(f"{folder}/{name}.idx") as f:
                    offsets = np.frombuffer(f.read(), "<i8")
                with files.open_input_file(f"{folder}/{name}.rec") as f:
                    a = 0
                    while a < len(offsets) - 1:
                        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + READ_BYTES, "right")) - 1)
                        rows, start = _rows(f.read_at(int(offsets[b] - offsets[a]), int(offsets[a])), b - a, start)
                        yield rows
                        a = b

    n = max(1, manifest.count())
    narrow = manifest.select("file", "start").repartition(n, "file")
    return map_batches(narrow, run, _READ).withColumnRenamed("file_start", "start")


def _rows(data: bytes, n: int, start: int) -> tuple[pa.RecordBatch, int]:
    keys, starts, counts, values, at = [], [], [], [], 0
    for _ in range(n):
        key, ids, at = parse(data, at)
        keys.append(key)
        starts.append(start)
        counts.append(len(ids))
        values.append(ids.astype("<u4").tobytes())
        start += len(ids)
    return pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(starts, pa.int64()), pa.array(counts, pa.int64()),
                                       pa.array(values, pa.binary())], names=["doc_id", "file_start", "n_tokens", "ids"]), start


def read_shuffled(spark: SparkSession, path: str, seed: int) -> DataFrame:
    """Records in a seeded order, fetched one by one through the index: ``position`` (hash of seed, file and record
    number; sorted by it), doc_id and ids. Only the narrow list of records is shuffled."""
    numbers = read_manifest(spark, path).select("file", F.explode(F.sequence(F.lit(0), F.col("n_docs").cast("int") - 1)).alias("i"))
    order = numbers.withColumn("position", F.xxhash64(F.lit(seed), "file", "i")).sort("position", "file", "i")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, folder = _store(path)
        opened: dict[str, tuple] = {}
        for batch in batches:
            names, numbers, positions = (c.to_pylist() for c in batch.columns)
            for lo in range(0, len(names), 256):
                keys, values = [], []
                for name, i in zip(names[lo:lo + 256], numbers[lo:lo + 256]):
                    if name not in opened:
                        if len(opened) >= 64:
                            opened.pop(next(iter(opened)))[0].close()
                        with files.open_input_file(f"{folder}/{name}.idx") as f:
                            offsets = np.frombuffer(f.read(), "<i8")
                        opened[name] = (files.open_input_file(f"{folder}/{name}.rec"), offsets)
                    data, offsets = opened[name]
                    key, ids, _ = parse(data.read_at(int(offsets[i + 1] - offsets[i]), int(offsets[i])), 0)
                    keys.append(key)
                    values.append(ids.astype("<u4").tobytes())
                yield pa.RecordBatch.from_arrays([pa.array(positions[lo:lo + 256], pa.int64()), pa.array(keys, pa.int64()),
                                                  pa.array(values, pa.binary())], names=["position", "doc_id", "ids"])

    return map_batches(order, run, "position long, doc_id long, ids binary")


def op10_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{shared_folder(spark).rstrip('/')}/pageprism/records-{uuid.uuid4().hex}"
    write_records(table(spark, sf_dir, "documents"), path)
    return read_records(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
