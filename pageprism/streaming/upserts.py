"""Page files as a stream: every micro-batch goes through the page facts into the result tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pageprism import schemas
from pageprism.operators.rules import RuleSet
from pageprism.operators.products import product_rows
from pageprism.plans.report import PRODUCT_COLUMNS, page_facts
from pageprism.sources.tables import upsert_results


def page_product_rows(pages: DataFrame, rules: RuleSet, archive_year: str, run_date: Column) -> DataFrame:
    """Product rows of fetched pages; row by row, so it runs on streams as it does on tables."""
    rows = product_rows(page_facts(pages, rules), ["domain", "url", *PRODUCT_COLUMNS])
    return rows.withColumns({"archive_year": F.lit(archive_year), "last_update": run_date}).select(
        *schemas.PRODUCTS.fieldNames())


def stream_products(spark: SparkSession, page_folder: str, result_path: str, checkpoint: str, rules: RuleSet,
                    query_year: str, run_date: Column, files_per_batch: int = 1000) -> StreamingQuery:
    """Reads page files as they arrive and upserts their products. The table notes the last batch of the stream, so a
    batch that runs twice after a failure is written once."""
    pages = (
        spark.readStream.schema(schemas.PAGE_RECORDS).option("maxFilesPerTrigger", files_per_batch)
        .parquet(page_folder)
    )
    rows = page_product_rows(pages, rules, query_year, run_date)
    return (
        rows.writeStream.foreachBatch(lambda batch, number: upsert_results(
            batch.sparkSession, "products", batch, result_path, query_year, batch=(checkpoint, number)))
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
