"""Positions inside groups of any size.

A plain ``row_number() OVER (PARTITION BY domain)`` sends a whole domain to one task. Pages are taken
in a seeded pseudo-random order, so the order key is a uniform hash: its leading digits cut every group into
buckets of equal expected size. Rows are numbered inside (group, bucket), and the buckets' counts,
at most ``16 ** BUCKET_DIGITS`` per group, give each bucket its offset.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKET_DIGITS = 3


def shuffle_key(*columns, seed: int = 0) -> Column:
    """Hexadecimal order key: a fixed pseudo-random order that any engine can reproduce."""
    parts = [F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit("")).cast("string") for c in columns]
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *parts).cast("binary"))


def rank_by_hash(df: DataFrame, keys: list[str], order: str, ties: list[str] = (), limit: int | None = None,
                 rank: str = "rn", total: str = "total") -> DataFrame:
    """Adds ``rank`` (1, 2, ...) and ``total`` (group size) per group in the order of the hash column.

    ``order`` should tell rows apart: rows that share it share a bucket (pages are unique per path once the
    latest captures are taken). With ``limit`` only the first ``limit`` rows of a group are returned; whole buckets beyond it are
    dropped before any sort. Rows with a null key are a group of their own.
    """
    group = [*keys, "_bucket"]
    work = df.withColumn("_bucket", F.substring(order, 1, BUCKET_DIGITS))
    before = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = work.groupBy(*group).agg(F.count(F.lit(1)).alias("_n")).select(
        *[F.col(k).alias(f"_of_{k}") for k in group],
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
        F.sum("_n").over(Window.partitionBy(*keys)).alias(total),
    )
    if limit is not None:
        offsets = offsets.where(F.col("_before") < limit)
    inside = Window.partitionBy(*group).orderBy(order, *ties)
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in group])
    ranked = work.join(offsets, same).withColumn(rank, F.row_number().over(inside) + F.col("_before"))
    if limit is not None:
        ranked = ranked.where(F.col(rank) <= limit)
    return ranked.drop("_bucket", "_before", *[f"_of_{k}" for k in group])


def salted_join(big: DataFrame, side: DataFrame, on: list[str], how: str = "left", salts: int = 32) -> DataFrame:
    """Join where one key may hold a large share of ``big``: its rows are spread over ``salts`` parts
    and the side, which has few rows per key, is repeated for each part. The salt is a hash of the row, so a
    retried task makes the same rows; identical copies share a salt and are split by adaptive execution."""
    spread = big.withColumn("_salt", F.pmod(F.xxhash64(*[F.col(c) for c in _hashable(big)]), F.lit(salts)).cast("int"))
    repeated = side.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return spread.join(repeated, [*on, "_salt"], how).drop("_salt")


def _hashable(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if f.dataType.typeName() in
            ("string", "long", "integer", "double", "date", "timestamp", "boolean")]
