"""Products of pages: from structured markup, else from the page head and price patterns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pageprism.functions.markup_text import page_head, tokens
from pageprism.functions.price import html_currency, html_price
from pageprism.functions.text import product_text
from pageprism.functions.urls import is_product_path, normalize_url
from pageprism.operators.dedupe import at_least_non_null
from pageprism.operators.language import detect_language
from pageprism.operators.rows import unnest
from pageprism.operators.markup import FIELDS, SYNTAXES, markup_columns, merge_markup


def with_tokens(pages: DataFrame, html: str = "html") -> DataFrame:
    return pages.withColumn("tokens", tokens(html))


def page_products(pages: DataFrame, html: str = "html") -> DataFrame:
    """Adds the product columns to pages with ``domain``, ``url_path``, ``html`` and ``tokens``.

    ``product_schema`` is true for products from markup, false for products from patterns and null
    for pages that are no product.
    """
    work = merge_markup(markup_columns(pages, html=html)).drop(*SYNTAXES)
    work = work.withColumns({
        "_markup_text": product_text("product_title", "product_description"),
        "_enough": at_least_non_null(["domain", "url_path", *FIELDS], 3),
        "_head": page_head("tokens"),
    })
    by_schema = F.col("_enough") & F.col("_markup_text").isNotNull()
    by_path = is_product_path("url_path")
    work = work.withColumns({
        "_head_text": product_text(F.col("_head.page_title"), F.col("_head.page_description")),
        "_schema": F.coalesce(by_schema, F.lit(False)),
    })
    by_pattern = ~F.col("_schema") & by_path & F.col("_head_text").isNotNull()
    work = work.withColumn("product_schema", F.when(F.col("_schema"), True).when(by_pattern, False))
    searched = F.when(F.col("product_schema") == F.lit(False), F.lower(html))
    work = work.withColumn("_lowered", searched)
    work = work.withColumns({"_price": html_price("_lowered"), "_currency": html_currency("_lowered")})
    both = F.col("_price").isNotNull() & F.col("_currency").isNotNull()
    pattern = F.col("product_schema") == F.lit(False)
    work = work.withColumn("_text", F.when(pattern, F.col("_head_text")).when(
        F.col("product_schema"), F.col("_markup_text")))
    return work.withColumns({
        "url": normalize_url("domain", "url_path"),
        "product_title": F.when(pattern, F.col("_head.page_title")).otherwise(F.col("product_title")),
        "product_description": F.when(pattern, F.col("_head.page_description")).otherwise(
            F.col("product_description")),
        "price": F.when(pattern & both, F.col("_price")).otherwise(F.col("price")),
        "currency": F.when(pattern & both, F.col("_currency")).otherwise(F.col("currency")),
        "detected_language": detect_language("_text"),
    }).drop("_markup_text", "_enough", "_head", "_head_text", "_schema", "_lowered", "_price", "_currency", "_text")


def product_rows(facts: DataFrame, columns: list[str]) -> DataFrame:
    """The products among pages with product columns.

    Written as an explode of at most one struct: a filter would be pushed below the projections that make
    ``product_schema`` and repeat all of their work.
    """
    one = F.when(F.col("product_schema").isNotNull(), F.struct(*columns))
    return unnest(facts, [], F.array(one), "_p").select("_p.*")
