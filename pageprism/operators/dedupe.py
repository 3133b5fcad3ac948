"""Distinct rows by key. All of these are aggregations, so copies are folded before the shuffle
and a key that holds a large share of all rows costs no more than any other."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _extreme(df: DataFrame, keys: list[str], order: list[str], pick) -> DataFrame:
    rest = [c for c in df.columns if c not in keys and c not in order]
    best = pick(F.struct(*[F.col(c) for c in [*order, *rest]])).alias("_best")
    return df.groupBy(*keys).agg(best).select(
        *[F.col(c) if c in keys else F.col("_best")[c].alias(c) for c in df.columns])


def keep_last(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The row with the greatest ``order`` columns per key; the other columns settle ties."""
    return _extreme(df, keys, order, F.max)


def keep_first(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The row with the smallest ``order`` columns per key; the other columns settle ties."""
    return _extreme(df, keys, order, F.min)


def latest_captures(index: DataFrame) -> DataFrame:
    """One index row per (domain, url_path): the one of the latest crawl."""
    return keep_last(index, ["domain", "url_path"], ["crawl", "warc_record_offset"])


def keep_latest(new: DataFrame, old: DataFrame | None, keys: list[str]) -> DataFrame:
    """Old and new result rows merged: the latest ``last_update`` per key wins, new rows win ties."""
    rows = new.withColumn("_generation", F.lit(1))
    if old is not None:
        rows = old.withColumn("_generation", F.lit(0)).unionByName(rows, allowMissingColumns=True)
    return keep_last(rows, keys, ["last_update", "_generation"]).drop("_generation")


def non_null_count(columns: list[str]):
    """Number of columns that carry a value."""
    terms = [F.col(c).isNotNull().cast("int") for c in columns]
    total = terms[0]
    for term in terms[1:]:
        total = total + term
    return total


def at_least_non_null(columns: list[str], minimum: int):
    return non_null_count(columns) >= minimum
