"""Shop report: products, links, social accounts, technologies and tracking of many domains."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pageprism import fixed, schemas
from pageprism.functions.headers import parse_headers
from pageprism.functions.markup_text import anchors
from pageprism.functions.urls import normalize_url
from pageprism.operators.budget import Limits, apply_budget, candidates, few_products, needs_live, order_number
from pageprism.operators.index import crawls_for_year, for_domains, page_candidates
from pageprism.operators.links import external_links, link_hosts, live_only, page_links, social_links
from pageprism.operators.products import page_products, product_rows, with_tokens
from pageprism.operators.rows import unnest
from pageprism.operators.rules import RuleSet
from pageprism.operators.technology import detected, page_technologies, with_categories, with_implied
from pageprism.session import stored
from pageprism.sources.records import fetch_records

PRODUCT_COLUMNS = ["detected_language", "product_title", "product_description", "brand", "price", "currency",
                   "product_schema"]


def page_facts(pages: DataFrame, rules: RuleSet) -> DataFrame:
    """Everything the report needs from a page, in one pass without a shuffle.

    Input: ``domain, url_path, response, header`` plus any other columns. Output: those without
    the page itself, plus ``url``, ``hits``, ``links`` and the product columns. Pages without
    content keep their row.
    """
    work = pages.withColumnRenamed("response", "html").withColumns({
        "url": normalize_url("domain", "url_path"),
        "headers": parse_headers("header"),
    })
    work = with_tokens(work).withColumn("links", anchors("tokens"))
    work = page_technologies(work, rules)
    return page_products(work).drop("html", "header", "headers", "tokens")


@dataclass(frozen=True)
class Report:
    """The five result tables, each a frame over the same facts of the checked pages."""

    facts: DataFrame
    seeds: DataFrame
    archive_counts: DataFrame
    live_counts: DataFrame | None
    rules: RuleSet
    archive_year: str
    run_date: Column

    def _stamped(self, df: DataFrame, name: str, year: Column | None = None) -> DataFrame:
        return df.withColumns({
            "archive_year": F.lit(self.archive_year) if year is None else year,
            "last_update": self.run_date,
        }).select(*schemas.RESULT_SCHEMAS[name].fieldNames())

    @property
    def products(self) -> DataFrame:
        year = F.when(F.col("origin") == "live", F.lit(fixed.LIVE_YEAR)).otherwise(F.lit(self.archive_year))
        rows = product_rows(self.facts, ["domain", "url", "origin", *PRODUCT_COLUMNS])
        return self._stamped(rows, "products", year)

    @property
    def _external(self) -> DataFrame:
        return external_links(page_links(self.facts.select("domain", "origin", "rn", "links")))

    @property
    def links(self) -> DataFrame:
        return self._stamped(link_hosts(self._external), "links")

    @property
    def social(self) -> DataFrame:
        return self._stamped(social_links(self._external, ["origin", "rn", "pos"]), "social")

    @property
    def technology(self) -> DataFrame:
        found = detected(self.facts, ["domain"])
        full = with_categories(with_implied(found, self.rules.implies, ["domain"]), self.rules.tech_categories)
        return self._stamped(full, "technology")

    @property
    def tracking(self) -> DataFrame:
        archive = F.col("origin") == "archive"
        checked = self.facts.groupBy("domain").agg(
            F.count_if(archive).alias("archive_record_count_checked"),
            F.count(F.lit(1)).alias("total_record_count_checked"),
            F.count_if(F.col("product_schema")).alias("product_count_schema"),
            F.count_if(~F.col("product_schema")).alias("product_count_pattern"))
        joined = self.seeds.select("domain").distinct().join(self.archive_counts, "domain", "left").join(
            checked, "domain", "left")
        live = F.lit(0)
        if self.live_counts is not None:
            joined = joined.join(self.live_counts, "domain", "left")
            live = F.coalesce("live_record_count", F.lit(0))
        names = [n for n, k in zip(schemas.TRACKING.fieldNames(), schemas.TRACKING.fields)
                 if k.dataType.typeName() == "long" and n != "total_record_count_unique"]
        full = joined.withColumn(
            "total_record_count_unique", F.coalesce("archive_record_count_unique", F.lit(0)) + live
        ).withColumns({n: F.coalesce(n, F.lit(0)).cast("long") for n in names})
        return self._stamped(full, "tracking")

    def tables(self) -> dict[str, DataFrame]:
        return {name: getattr(self, name) for name in schemas.RESULT_SCHEMAS}


def from_archive(root: str) -> Callable[[DataFrame], DataFrame]:
    """Fetches the wanted records out of archive files: only their byte ranges are read."""
    return lambda wanted: fetch_records(wanted, root)


def from_table(pages: DataFrame, year=None) -> Callable[[DataFrame], DataFrame]:
    """Takes the wanted records of the year's crawls out of a page table. The wanted keys are a written table whose size
    Spark knows: it broadcasts few of them, so page contents stay where they are, and else joins by the record key.

    The pages are the outer side of the join, so they are never the side that Spark broadcasts, whatever size it takes them for (pages that are made
    from small files look small). The rows without a wanted key go behind an explode, since a filter would make the join an inner one again.
    """
    keys = ["domain", "url_path", "crawl", "warc_filename", "warc_record_offset"]
    contents = ["response", "header"]
    of_year = pages.where(F.col("crawl").isin(crawls_for_year(year)))

    def take(wanted: DataFrame) -> DataFrame:
        rest = F.struct(*[c for c in wanted.columns if c not in keys])
        joined = of_year.select(*keys, *contents).join(wanted.select(*keys, rest.alias("_rest")), keys, "left")
        return unnest(joined, [*keys, *contents], F.array("_rest"), "_wanted").select(*keys, *contents, "_wanted.*")

    return take


def shop_report(index: DataFrame, fetch: Callable[[DataFrame], DataFrame], seeds: DataFrame, rules: RuleSet,
                run_date: Column, year=None, live: DataFrame | None = None, limits: Limits | None = None,
                seed: int = 0, store: bool = True) -> Report:
    """Report over all archived pages of the seeds.

    ``index`` is the page index; ``fetch`` turns index rows into pages. With ``limits`` only the pages that this budget
    can reach are fetched, and its stop rules decide which count. ``live`` holds ``domain, url_path, link, response,
    header`` of pages collected from the sites themselves, used for domains whose archive ran out with few products.

    The candidates are written to the shared folder. With ``store`` so are the facts, once, and all five tables
    read them there, each only its own columns.
    """
    wanted = for_domains(index.where(F.col("crawl").isin(crawls_for_year(year))), seeds)
    unique = page_candidates(wanted)
    # The candidates are narrow index rows that the fetch, the facts and the tracking table all need.
    if limits is None:
        chosen = stored(unique.withColumn("rn", order_number("url_path", seed=seed)), "candidates")
        counts = chosen.groupBy("domain").agg(F.count(F.lit(1)).alias("archive_record_count_unique"))
    else:
        chosen = stored(candidates(unique, seed=seed, limits=limits), "candidates")
        counts = chosen.groupBy("domain").agg(F.max("total").alias("archive_record_count_unique"))
    facts = page_facts(fetch(chosen).withColumn("origin", F.lit("archive")), rules)
    facts = facts.withColumn("is_product", F.col("product_schema").isNotNull())
    if store:
        facts = stored(facts, "facts")
    checked = facts if limits is None else apply_budget(facts, limits)
    live_counts = None
    columns = ["domain", "url", "origin", "rn", "links", "hits", *PRODUCT_COLUMNS]
    if live is not None:
        short = few_products(seeds, checked) if limits is None else needs_live(seeds, checked)
        # Keys decide; the contents move once, and only those that are wanted are parsed.
        fresh = live_only(live.select("domain", "link").distinct().join(short, "domain", "left_semi"), checked)
        live_facts = page_facts(live.join(stored(fresh, "live-keys"), ["domain", "link"], "left_semi").withColumns({
            "origin": F.lit("live"), "rn": F.lit(0).cast("long")}), rules)
        if store:
            live_facts = stored(live_facts, "live-facts")
        live_counts = live_facts.groupBy("domain").agg(F.count(F.lit(1)).alias("live_record_count"))
        checked = checked.select(*columns).unionByName(live_facts.select(*columns))
    else:
        checked = checked.select(*columns)
    return Report(checked, seeds, counts, live_counts, rules, str(year or fixed.DEFAULT_YEAR), run_date)


def write_report(spark: SparkSession, report: Report, folder: str, query_year) -> None:
    """Keep-latest upsert of all five tables."""
    from pageprism.sources.tables import upsert_results

    for name, table in report.tables().items():
        upsert_results(spark, name, table, f"{folder.rstrip('/')}/{name}", str(query_year))
