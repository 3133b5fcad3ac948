"""Index acquisition: seed domains against the crawl index, hits into the local index."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pageprism.operators.index import crawls_for_year, for_domains, select_index
from pageprism.sources.snapshots import manifest
from pageprism.sources.tables import read_crawl_index, read_seeds, upsert_index


def acquire(index_table: DataFrame, seeds: DataFrame, year=None) -> DataFrame:
    """Index rows of the seeds in the crawls of a year, as one plan over all crawls and seeds."""
    return for_domains(select_index(index_table, crawls_for_year(year)), seeds)


def run(spark: SparkSession, seeds_path: str, index_table_path: str, index_path: str, year=None) -> dict[str, int]:
    """Queries the index and upserts the hits; returns row counts before and after, which the versions of the local index hold."""
    before = manifest(spark, index_path).rows
    hits = acquire(read_crawl_index(spark, index_table_path), read_seeds(spark, seeds_path), year)
    after = upsert_index(spark, hits, index_path).rows
    return {"rows_before": before, "rows_after": after, "rows_added": after - before}
