"""Rows out of arrays, and rows spread over the cluster."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def unnest(df: DataFrame, keep: list, array: Column, name: str) -> DataFrame:
    """One row per non-null element. An inner explode makes the optimizer test the array for emptiness in a
    filter below, which computes an expensive array twice; the outer form with a filter behind it does not."""
    return df.select(*keep, F.explode_outer(array).alias(name)).where(F.col(name).isNotNull())


def unnest_positions(df: DataFrame, keep: list, array: Column, pos: str, name: str) -> DataFrame:
    return df.select(*keep, F.posexplode_outer(array).alias(pos, name)).where(F.col(name).isNotNull())


def spread(scan: DataFrame) -> DataFrame:
    """A table that lies in fewer splits than the cluster has cores, spread over all cores before
    row-by-row work that is heavy; any other table as it is. Only for plain scans."""
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores) if scan.rdd.getNumPartitions() < cores else scan
