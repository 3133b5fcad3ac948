"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

TEXT_GROUP_BYTES = 2 << 20
BATCH_BYTES = "2m"
_BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def map_batches(df: DataFrame, run, schema: str) -> DataFrame:
    """``mapInArrow`` with batches bounded by bytes too, unless the session has set a bound: ten thousand whole texts at once
    would take a worker's memory."""
    if df.sparkSession.conf.get(_BATCH_SETTING, None) is None:
        df.sparkSession.conf.set(_BATCH_SETTING, BATCH_BYTES)
    return df.mapInArrow(run, schema)


def column_bytes(column: pa.Array) -> list[bytes]:
    """Values of a string column as UTF-8; null counts as empty."""
    return [v or b"" for v in column.cast(pa.binary()).to_pylist()]


def groups_by_bytes(texts: list[bytes], most: int = TEXT_GROUP_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows that hold about ``most`` bytes of text each, one row at least; bounds the memory of
    what is made from a batch at once."""
    start = held = 0
    for i, text in enumerate(texts):
        if held and held + len(text) > most:
            yield start, i
            start, held = i, 0
        held += len(text)
    if start < len(texts):
        yield start, len(texts)


def spread_ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions ``starts[i] .. starts[i] + lengths[i] - 1`` of all i, one after another."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(total)
