"""Seed lists, crawl index tables, page tables and result tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pageprism import schemas
from pageprism.operators.dedupe import keep_latest
from pageprism.operators.index import merge_index
from pageprism.sources.snapshots import Manifest, read_snapshot, upsert

RESULT_BUCKETS = 64
INDEX_BUCKETS = 16


def read_seeds(spark: SparkSession, path: str) -> DataFrame:
    """First column of a CSV file without header."""
    return spark.read.schema(schemas.SEEDS).csv(path, header=False, mode="PERMISSIVE").where("domain IS NOT NULL")


def read_crawl_index(spark: SparkSession, path: str) -> DataFrame:
    """Public crawl index table, partitioned by ``crawl`` and ``subset``."""
    return spark.read.schema(schemas.CRAWL_INDEX_TABLE).parquet(path)


def read_index_csv(spark: SparkSession, path: str) -> DataFrame:
    """Query result of the crawl index as CSV with header."""
    return spark.read.schema(schemas.PAGE_INDEX).csv(path, header=True, enforceSchema=False)


def _bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64("domain"), F.lit(buckets)).cast("int").cast("string")


def read_index(spark: SparkSession, path: str, crawls: list[str] | None = None) -> DataFrame:
    """Local index, empty when it was never written; with ``crawls`` only their parts are read."""
    wanted = None if crawls is None else (lambda part: part.rpartition(".")[0] in crawls)
    return read_snapshot(spark, path, schemas.PAGE_INDEX, wanted=wanted)


def upsert_index(spark: SparkSession, new: DataFrame, path: str) -> Manifest:
    """Adds index rows to the local index, each once. Only the parts (crawl, bucket of the domain) that occur in ``new`` are
    read and rewritten. Returns the new version, with its row count."""
    part = F.concat(F.coalesce("crawl", F.lit("")), F.lit("."), F.coalesce(_bucket(INDEX_BUCKETS), F.lit("")))
    return upsert(spark, path, new, part, schemas.PAGE_INDEX, merge_index)


def _result_schema(name: str) -> T.StructType:
    extra = [] if name == "tracking" else [T.StructField("query_year", T.StringType())]
    return T.StructType([*schemas.RESULT_SCHEMAS[name].fields, *extra])


def read_results(spark: SparkSession, name: str, path: str, version: int | None = None) -> DataFrame:
    """Result table, empty when it was never written: the latest version or the given one."""
    return read_snapshot(spark, path, _result_schema(name), version)


def upsert_results(spark: SparkSession, name: str, new: DataFrame, path: str, query_year: str, batch: tuple[str, int] | None = None) -> Manifest:
    """Keep-latest upsert into a result table, whose parts are hash buckets of the domain, in the tables but for tracking of each query year.
    Readers see the table before or after it, never between. ``batch`` (stream, number) is written once."""
    schema, keys = _result_schema(name), schemas.RESULT_KEYS[name]
    part = F.coalesce(_bucket(RESULT_BUCKETS), F.lit(""))
    if name != "tracking":
        new = new.withColumn("query_year", F.lit(str(query_year)))
        part = F.concat("query_year", F.lit("."), part)
    return upsert(spark, path, new, part, schema, lambda old, rows: keep_latest(rows, old, keys), batch)


def read_page_files(spark: SparkSession, path: str) -> DataFrame:
    """Fetched records: ``domain, crawl, url_path, response, header``."""
    return spark.read.schema(schemas.PAGE_RECORDS).parquet(path)


def live_as_pages(live: DataFrame) -> DataFrame:
    """Live records in the shape of fetched records: ``link`` stays, path and domain come from it."""
    from pageprism.functions.urls import url_host, url_path

    domain = F.col("domain") if "domain" in live.columns else url_host("link")
    return live.select(
        domain.alias("domain"), F.lit("LIVE-CRAWL").alias("crawl"), url_path("link").alias("url_path"),
        F.col("content").alias("response"), "header", "link")
