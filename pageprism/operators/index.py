"""Crawl index: selection, look-up, upsert, calendar."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pageprism import fixed, schemas
from pageprism.functions.urls import crawl_id, is_page_path
from pageprism.operators.dedupe import latest_captures

# IN lists stay literals up to this length, so they reach the Parquet scan as pushed filters.
MAX_IN_LIST = 500


def crawl_calendar(spark: SparkSession) -> DataFrame:
    """Crawl ids per year."""
    rows = [(year, f"{year}-{week}") for year, weeks in fixed.CRAWL_WEEKS.items() for week in weeks.split()]
    return spark.createDataFrame(rows, schemas.CRAWL_CALENDAR)


def crawls_for_year(year=None) -> list[str]:
    """Crawl ids of a year; those of the default year when the year is missing or unknown."""
    known = fixed.CRAWL_WEEKS
    key = int(year) if year is not None and int(year) in known else fixed.DEFAULT_YEAR
    return [f"{fixed.CRAWL_PREFIX}{key}-{week}" for week in known[key].split()]


def crawls_of_years(spark: SparkSession, df: DataFrame, year: str) -> DataFrame:
    """Rows joined with the crawl ids of their year, unknown years with those of the default year."""
    per_year = crawl_calendar(spark).groupBy("year").agg(
        F.sort_array(F.collect_list(crawl_id("crawl"))).alias("crawls"))
    known = F.array(*[F.lit(y) for y in fixed.CRAWL_WEEKS])
    wanted = F.when(F.array_contains(known, F.col(year)), F.col(year)).otherwise(F.lit(fixed.DEFAULT_YEAR))
    return (
        df.withColumn("_year", wanted)
        .join(F.broadcast(per_year.withColumnRenamed("year", "_year")), "_year")  # seven rows
        .drop("_year")
    )


def select_index(table: DataFrame, crawls: list[str], subset: str = "warc") -> DataFrame:
    """The six index columns for some crawls: one scan, pruned to the ``crawl``/``subset`` partitions."""
    return table.where(F.col("crawl").isin(crawls) & (F.col("subset") == subset)).select(
        F.col("url_host_registered_domain").alias("domain"),
        "crawl", "url_path", "warc_filename", "warc_record_offset", "warc_record_length",
    )


def for_domains(index: DataFrame, seeds: DataFrame) -> DataFrame:
    """Index rows whose domain is a seed. Spark broadcasts a seed list whose statistics are small; a long one is joined
    by domain, and adaptive execution splits a domain that owns a large share of the index."""
    wanted = seeds.select("domain").where("domain IS NOT NULL").distinct()
    return index.join(wanted, "domain", "left_semi").select(*index.columns)


def lookup(index: DataFrame, domains: list[str], crawls: list[str]) -> DataFrame:
    """Index rows of some domains in some crawls; both lists are pushed to the scan. A long list of domains is joined
    as a table."""
    if len(domains) > MAX_IN_LIST:
        seeds = index.sparkSession.createDataFrame([(d,) for d in domains], "domain string")
        return for_domains(index.where(F.col("crawl").isin(crawls)), seeds)
    return index.where(F.col("domain").isin(domains) & F.col("crawl").isin(crawls))


def page_candidates(index: DataFrame) -> DataFrame:
    """Latest capture per path, files left out. The suffix test comes first: it depends on the path
    alone, so it removes the same rows before the shuffle as it would behind it."""
    return latest_captures(index.where(is_page_path("url_path")))


def seed_hits(seeds: DataFrame, index: DataFrame) -> DataFrame:
    """Unique index rows per seed domain, zero for seeds without any."""
    hits = index.groupBy("domain").agg(F.count(F.lit(1)).alias("archive_record_count_unique"))
    return seeds.select("domain").distinct().join(hits, "domain", "left").select(
        "domain", F.coalesce("archive_record_count_unique", F.lit(0)).alias("archive_record_count_unique"))


def merge_index(existing: DataFrame, new: DataFrame) -> DataFrame:
    """Distinct union of index rows."""
    columns = schemas.PAGE_INDEX.fieldNames()
    return existing.select(*columns).union(new.select(*columns)).distinct()


def rows_added(existing: DataFrame, merged: DataFrame) -> DataFrame:
    """Row counts before and after a merge, and their difference, as one row."""
    before = existing.agg(F.count(F.lit(1)).alias("rows_before"))
    after = merged.agg(F.count(F.lit(1)).alias("rows_after"))
    both = before.withColumn("_one", F.lit(1)).join(after.withColumn("_one", F.lit(1)), "_one")
    return both.select("rows_before", "rows_after", (F.col("rows_after") - F.col("rows_before")).alias("rows_added"))
