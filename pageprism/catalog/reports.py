"""Registered queries over whole reports, result upserts, the frontier and archived records."""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from pageprism.catalog.frames import PAGE_INDEX_SQL, SHOP_SQL, page_index, shop_pages, table
from pageprism.catalog.markups import HOST_SQL
from pageprism.catalog.technologies import CATEGORY_SQL, SHOP_TECH_SQL
from pageprism.functions.markup_text import page_head, tokens
from pageprism.functions.urls import is_page_path, normalize_url
from pageprism.operators.budget import Limits
from pageprism.operators.dedupe import keep_last, keep_latest as latest
from pageprism.operators.frontier import frontier as walk
from pageprism.plans.report import from_table, shop_report as report_of
from pageprism.sources.records import fetch_records, write_records
from pageprism.sources.rule_files import sample_rules

RUN_DATE = datetime.date(2024, 6, 1)
BUDGET = Limits(batch_size=10, max_pages=60, max_products=28, relevance_check=20, relevance_threshold=2.0)


def _report(spark, sf_dir):
    shop = shop_pages(spark, sf_dir)
    seeds = shop.select("domain").distinct()
    return report_of(shop.drop("response", "header"), from_table(shop), seeds, sample_rules(spark), F.lit(RUN_DATE),
                     store=False)


def report_products(spark, sf_dir):
    return _report(spark, sf_dir).products


def report_links(spark, sf_dir):
    return _report(spark, sf_dir).links


def report_social(spark, sf_dir):
    return _report(spark, sf_dir).social


def report_technology(spark, sf_dir):
    found = _report(spark, sf_dir).technology
    return found.withColumn("categories", F.array_join("categories", "|"))


def tracking(spark, sf_dir):
    return _report(spark, sf_dir).tracking


def shop_report(spark, sf_dir):
    """The whole report in one row per domain."""
    shop = shop_pages(spark, sf_dir)
    seeds = shop.select("domain").distinct()
    r = report_of(shop.drop("response", "header"), from_table(shop), seeds, sample_rules(spark), F.lit(RUN_DATE))
    count = F.count(F.lit(1))
    tables = [
        r.products.groupBy("domain").agg(count.alias("products"), F.round(F.sum("price"), 2).alias("total_price")),
        r.links.groupBy("domain").agg(count.alias("link_hosts"), F.sum("count").alias("external_urls")),
        r.social.groupBy("domain").agg(count.alias("accounts")),
        r.technology.groupBy("domain").agg(count.alias("technologies")),
    ]
    out = r.tracking.select("domain", "archive_record_count_unique", "product_count_schema", "product_count_pattern")
    for part in tables:
        out = out.join(part, "domain", "left")
    return out


def report_budgeted(spark, sf_dir):
    """Tracking of a report under an explicit page budget."""
    shop = shop_pages(spark, sf_dir)
    seeds = shop.select("domain").distinct()
    r = report_of(shop.drop("response", "header"), from_table(shop), seeds, sample_rules(spark), F.lit(RUN_DATE),
                  limits=BUDGET)
    return r.tracking.select("domain", "archive_record_count_unique", "archive_record_count_checked",
                             "product_count_schema", "product_count_pattern")


def live_top_up(spark, sf_dir):
    """Products of a report whose archive lacks the pattern pages, which the live pages bring back."""
    shop = shop_pages(spark, sf_dir)
    archive = shop.where(F.col("url_path").startswith("/about/"))
    live = shop.withColumn("link", normalize_url("domain", "url_path")).select(
        "domain", "url_path", "link", "response", "header")
    seeds = shop.select("domain").distinct()
    r = report_of(archive.drop("response", "header"), from_table(archive), seeds, sample_rules(spark),
                  F.lit(RUN_DATE), live=live)
    return r.products.groupBy("domain", "archive_year", "product_schema").agg(F.count(F.lit(1)).alias("products"))


def page_summary(spark, sf_dir):
    """Pages per domain of the given pages: latest capture per canonical URL, files left out, by language."""
    index = page_index(spark, sf_dir).where(is_page_path("url_path"))
    keyed = index.select(normalize_url("domain", "url_path").alias("url"), "domain", "crawl",
                         F.col("warc_record_offset").alias("page_id"))
    newest = keep_last(keyed, ["url"], ["crawl", "page_id"])
    pages = table(spark, sf_dir, "pages").select("page_id", tokens("html").alias("tokens"))
    heads = pages.select("page_id", page_head("tokens").alias("h")).select("page_id", "h.language", "h.page_title")
    return newest.join(heads, "page_id").groupBy("domain", "language").agg(
        F.count(F.lit(1)).alias("pages"), F.count_distinct("page_title").alias("titles"))


def upsert_latest(spark, sf_dir):
    """Two generations of a result table that share keys and dates, merged."""
    orders = table(spark, sf_dir, "orders")
    rows = orders.select(
        F.col("o_custkey").cast("string").alias("domain"), F.col("o_orderpriority").alias("url"),
        F.to_date("o_orderdate").alias("last_update"), F.col("o_orderkey").alias("order_key"),
        F.col("o_orderstatus").alias("status"))
    new = rows.where(F.col("status") != "F").drop("status")
    old = rows.where(F.col("status") != "P").drop("status")
    return latest(new, old, ["domain", "url"])


def frontier(spark, sf_dir):
    """Breadth-first walk over the links order -> part, one site per return flag."""
    links = table(spark, sf_dir, "lineitem").select(
        F.col("l_returnflag").alias("domain"), F.col("l_orderkey").cast("string").alias("source"),
        F.col("l_partkey").cast("string").alias("target"))
    roots = links.groupBy("domain").agg(F.min(F.col("source").cast("bigint")).cast("string").alias("page"))
    return walk(links, roots)


def warc_records(spark, sf_dir):
    """Given pages written as archive records, located by file, offset and length, and read back."""
    pages = table(spark, sf_dir, "pages").withColumnRenamed("html", "response").join(
        page_index(spark, sf_dir).select(F.col("warc_record_offset").alias("page_id"), "domain", "crawl", "url_path"),
        "page_id")
    located, root = write_records(pages.withColumn(
        "header", F.concat(F.lit("HTTP/1.1 200 OK\r\nX-Page: "), F.col("page_id").cast("string"))))
    return fetch_records(located, root).select(
        "domain", "crawl", "url_path", "header", F.md5(F.col("response").cast("binary")).alias("digest"))


QUERIES = {f.__name__: f for f in (
    report_products, report_links, report_social, report_technology, tracking, shop_report,
    report_budgeted, live_top_up,
    page_summary, upsert_latest, frontier, warc_records)}

_STAMP = "'2024' AS archive_year, DATE '2024-06-01' AS last_update"
ORACLES = {
    "report_products": f"WITH {SHOP_SQL} SELECT domain, 'https://' || domain || clean_path AS url, lang AS detected_language, "
                       f"product_title, product_description, brand, price, currency, product_schema, {_STAMP} "
                       "FROM shop_products WHERE product_schema IS NOT NULL",
    "report_links": f"WITH {SHOP_SQL} SELECT domain, {HOST_SQL} AS external_link, count(DISTINCT href) AS count, {_STAMP} "
                    "FROM shop_links GROUP BY domain, external_link",
    "report_social": f"WITH {SHOP_SQL} SELECT DISTINCT domain, platform AS social_platform, account AS social_link, {_STAMP} FROM shop",
    "report_technology": f"WITH {SHOP_SQL}, {SHOP_TECH_SQL}, {CATEGORY_SQL} SELECT domain, technology, max(version) AS version, "
                         f"any_value(categories) AS categories, {_STAMP} FROM implied JOIN names USING (technology) "
                         "GROUP BY domain, technology",
    "tracking": f"WITH {SHOP_SQL} SELECT domain, count(*) AS archive_record_count_unique, count(*) AS archive_record_count_checked, "
                "count(*) AS total_record_count_unique, count(*) AS total_record_count_checked, "
                "count(CASE WHEN product_schema THEN 1 END) AS product_count_schema, "
                f"count(CASE WHEN NOT product_schema THEN 1 END) AS product_count_pattern, {_STAMP} FROM shop_products GROUP BY domain",
    "shop_report": f"""WITH {SHOP_SQL}, {SHOP_TECH_SQL},
      p AS (SELECT domain, count(*) AS archive_record_count_unique,
                   count(CASE WHEN product_schema THEN 1 END) AS product_count_schema,
                   count(CASE WHEN NOT product_schema THEN 1 END) AS product_count_pattern,
                   count(product_schema) AS products,
                   round(sum(CASE WHEN product_schema IS NOT NULL THEN price END), 2) AS total_price
            FROM shop_products GROUP BY domain),
      l AS (SELECT domain, count(DISTINCT {HOST_SQL}) AS link_hosts, CAST(count(DISTINCT href) AS BIGINT) AS external_urls
            FROM shop_links GROUP BY domain),
      s AS (SELECT domain, count(DISTINCT account) AS accounts FROM shop GROUP BY domain),
      t AS (SELECT domain, count(DISTINCT technology) AS technologies FROM implied GROUP BY domain)
      SELECT * FROM p JOIN l USING (domain) JOIN s USING (domain) JOIN t USING (domain)""",
    "live_top_up": f"""WITH {SHOP_SQL} SELECT domain, CASE WHEN k % 3 = 2 THEN '2024' ELSE 'LIVE-CRAWL' END AS archive_year,
      product_schema, count(*) AS products FROM shop_products WHERE product_schema IS NOT NULL GROUP BY ALL""",
    "page_summary": f"""WITH {PAGE_INDEX_SQL}, keyed AS (
        SELECT *, regexp_replace(regexp_replace('https://' || domain || url_path, '/+$', ''), '(\\?.+)|(#.+)', '', 'g') AS url
        FROM page_index),
      newest AS (SELECT * FROM keyed QUALIFY row_number() OVER (PARTITION BY url ORDER BY crawl DESC, warc_record_offset DESC) = 1)
      SELECT n.domain, regexp_extract(html, '<html lang="([a-z]+)', 1) AS language, count(*) AS pages,
             count(DISTINCT trim(regexp_extract(html, '<title>(.*?)</title>', 1))) AS titles
      FROM newest n JOIN pages p ON p.page_id = n.warc_record_offset GROUP BY ALL""",
    "upsert_latest": """WITH rows AS (SELECT CAST(o_custkey AS VARCHAR) AS domain, o_orderpriority AS url,
        CAST(o_orderdate AS DATE) AS last_update, o_orderkey AS order_key, o_orderstatus AS status FROM orders),
      both_ AS (SELECT *, 1 AS g FROM rows WHERE status <> 'F' UNION ALL SELECT *, 0 FROM rows WHERE status <> 'P')
      SELECT domain, url, last_update, order_key FROM both_ QUALIFY row_number() OVER (
        PARTITION BY domain, url ORDER BY last_update DESC, g DESC, order_key DESC) = 1""",
    "report_budgeted": f"""WITH {SHOP_SQL},
      batched AS (SELECT *, CAST((row_number() OVER (PARTITION BY domain ORDER BY md5('0|' || url_path), url_path) - 1) // 10 AS BIGINT)
                  AS batch FROM shop_products),
      sums AS (SELECT domain, batch, count(*) AS p, count(product_schema) AS c FROM batched GROUP BY ALL),
      running AS (SELECT domain, batch, sum(p) OVER w AS p, sum(c) OVER w AS c FROM sums WINDOW w AS (PARTITION BY domain ORDER BY batch)),
      stops AS (SELECT domain, min(batch) AS last FROM running WHERE p > 60 OR c > 28 OR (p >= 28 AND c = 0)
                OR (p >= 20 AND c * 100.0 / p < 2.0) GROUP BY domain),
      kept AS (SELECT b.* FROM batched b LEFT JOIN stops s ON s.domain = b.domain WHERE s.last IS NULL OR b.batch <= s.last),
      total AS (SELECT domain, count(*) AS archive_record_count_unique FROM batched GROUP BY domain)
      SELECT domain, archive_record_count_unique, count(*) AS archive_record_count_checked,
             count(CASE WHEN product_schema THEN 1 END) AS product_count_schema,
             count(CASE WHEN NOT product_schema THEN 1 END) AS product_count_pattern
      FROM kept JOIN total USING (domain) GROUP BY ALL""",
    "frontier": """WITH RECURSIVE links AS (SELECT DISTINCT l_returnflag AS domain, l_orderkey AS source, l_partkey AS target FROM lineitem),
      walk(domain, page, depth) USING KEY (domain, page) AS (
        SELECT domain, min(source), 0 FROM links GROUP BY domain
        UNION SELECT w.domain, l.target, min(w.depth + 1) FROM walk w JOIN links l ON l.domain = w.domain AND l.source = w.page
        WHERE NOT EXISTS (SELECT 1 FROM recurring.walk r WHERE r.domain = l.domain AND r.page = l.target)
        GROUP BY w.domain, l.target)
      SELECT domain, CAST(page AS VARCHAR) AS page, CAST(depth AS INTEGER) AS depth, row_number() OVER (
        PARTITION BY domain ORDER BY depth, md5('0|' || CAST(page AS VARCHAR)), CAST(page AS VARCHAR)) AS position FROM walk""",
    "warc_records": f"WITH {PAGE_INDEX_SQL} SELECT domain, crawl, url_path, 'HTTP/1.1 200 OK' || chr(13) || chr(10) || 'X-Page: ' || page_id AS header, "
                    "md5(trim(html)) AS digest FROM page_index JOIN pages ON page_id = warc_record_offset",
}
