"""Cost-balanced packing of documents into training sequences."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pageprism.llm.common import column_bytes, groups_by_bytes, map_batches, table
from pageprism.llm.tokens import default_tokenizer, encoder, tokenizer_text

SEQUENCE_TOKENS = 4096
WINDOW_SEQUENCES = 512
BATCH_PIECES = 1024  # of a result batch, some MB of ids
LINEAR_COST = 1.0
QUADRATIC_COST = 1.0 / 1024
END_ID = 2

PIECES = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"
_ARROW = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("doc_tokens", pa.int64()),
                    ("sequence_id", pa.int64()), ("offset", pa.int64()), ("ids", pa.binary())])


def cost(length, linear: float = LINEAR_COST, quadratic: float = QUADRATIC_COST):
    """Estimated cost of attention over a piece of ``length`` tokens that sees only itself."""
    return linear * length + quadratic * length * length


def assign(lengths: np.ndarray, capacity: int = SEQUENCE_TOKENS, linear: float = LINEAR_COST,
           quadratic: float = QUADRATIC_COST) -> list[tuple[int, int, int, int, int]]:
    """Places documents into as few sequences as their tokens need: (document, start, length, sequence, offset).

    Documents beyond ``capacity`` first give whole sequences; what is left of each goes, longest first, to the sequence of
    lowest cost that has room for it. A document for which no sequence has room is cut: it fills the cheapest sequences
    that have any. So at most the last sequence's worth of tokens is padding.
    """
    placed, rest, full = [], [], 0
    for document, length in enumerate(lengths.tolist()):
        whole = length // capacity
        placed += [(document, i * capacity, capacity, full + i, 0) for i in range(whole)]
        full += whole
        if length % capacity:
            rest.append((length % capacity, document, whole * capacity))
    rest.sort(key=lambda r: (-r[0], r[1]))
    n = -(-sum(r[0] for r in rest) // capacity)
    spent, free = np.zeros(n), np.full(n, capacity, np.int64)
    for length, document, start in rest:
        while length:
            fits = np.where(free >= length, spent, np.inf)
            to = int(fits.argmin())
            take = length
            if not np.isfinite(fits[to]):
                to = int(np.where(free > 0, spent, np.inf).argmin())
                take = int(free[to])
            placed.append((document, start, take, full + to, capacity - int(free[to])))
            spent[to] += cost(take, linear, quadratic)
            free[to] -= take
            length -= take
            start += take
    return placed


def pack(docs: DataFrame, tokenizer_path: str | None = None, end_id: int = END_ID, capacity: int = SEQUENCE_TOKENS,
         window_sequences: int = WINDOW_SEQUENCES, linear: float = LINEAR_COST,
         quadratic: float = QUADRATIC_COST) -> DataFrame:
    """Token ids of whole documents in sequences of at most ``capacity`` tokens, one row per piece.

    Each task encodes its documents and packs them window by window (``window_sequences`` sequences' worth of tokens), so
    nothing is shuffled and memory is bounded. ``ids`` holds the piece as little-endian unsigned 32-bit
    integers. Sequence ids are unique over tasks; pieces of a sequence follow one another without gaps.

    A null text counts as empty and gives the end id alone; a null doc_id stays null; repeated rows are packed each;
    a document beyond ``capacity`` is cut. An empty table gives no rows. Other columns are left out.
    """
    tokenizer = docs.sparkSession.sparkContext.broadcast(tokenizer_text(tokenizer_path or default_tokenizer()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        sequence = (context.partitionId() if context else 0) << 33
        encode = encoder(tokenizer.value).encode
        window: list[tuple[int | None, np.ndarray]] = []
        held = 0
        for batch in batches:
            keys, texts = batch.column(0).to_pylist(), column_bytes(batch.column(1))
            for a, b in groups_by_bytes(texts):
                ids, counts = encode(texts[a:b])
                for key, own in zip(keys[a:b], np.split(ids, np.cumsum(counts)[:-1])):
                    window.append((key, np.append(own, np.uint32(end_id)).astype("<u4")))
                    held += len(own) + 1
                    if held >= window_sequences * capacity:
                        made = yield from emit(window, sequence)
                        sequence, window, held = sequence + made, [], 0
        yield from emit(window, sequence)

    def emit(window, sequence):
        lengths = np.array([len(ids) for _, ids in window], np.int64)
        placed = assign(lengths, capacity, linear, quadratic)
        for i in range(0, len(placed), BATCH_PIECES):
            part = placed[i:i + BATCH_PIECES]
            yield pa.RecordBatch.from_arrays([
                pa.array([window[d][0] for d, *_ in part], pa.int64()),
                pa.array([p[1] for p in part], pa.int64()), pa.array([p[2] for p in part], pa.int64()),
                pa.array([int(lengths[d]) for d, *_ in part], pa.int64()),
                pa.array([sequence + p[3] for p in part], pa.int64()), pa.array([p[4] for p in part], pa.int64()),
                pa.array([window[d][1][s:s + n].tobytes() for d, s, n, *_ in part], pa.binary())], schema=_ARROW)
        return max((p[3] for p in placed), default=-1) + 1

    return map_batches(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), run, PIECES)


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = pack(table(spark, sf_dir, "documents"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id",
                         "offset")
