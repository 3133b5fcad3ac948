"""Registered queries over the page index."""

from __future__ import annotations

from pyspark.sql import functions as F

from pageprism import fixed
from pageprism.catalog.frames import CAPTURES_SQL, PAGE_INDEX_SQL, captures, page_index, table
from pageprism.functions.urls import (
    authority, canonical_link, is_page_path, normalize_url, strip_www, url_host,
)
from pageprism.operators import budget, dedupe, index
from pageprism.operators.domains import registered_domain
from pageprism.operators.frontier import on_asked_domain
from pageprism.operators.links import archive_and_live, live_only
from pageprism.operators.ranking import shuffle_key

LOOKUP_DOMAINS = ["therin.example.net", "thther.example.org", "spam-farm.example.org", "cheap-pills.example.com"]
LOOKUP_CRAWLS = ["CC-MAIN-2024-10", "CC-MAIN-2024-22", "CC-MAIN-2024-26"]


def index_lookup(spark, sf_dir):
    return index.lookup(captures(spark, sf_dir), LOOKUP_DOMAINS, LOOKUP_CRAWLS)


def suffix_filter(spark, sf_dir):
    return page_index(spark, sf_dir).where(is_page_path("url_path")).select("domain", "url_path")


def seeds(spark, sf_dir):
    """Domains that some page answers over https."""
    pages = table(spark, sf_dir, "pages").where(F.col("url").startswith("https://"))
    return pages.select(F.regexp_replace(authority("url"), r"^(www|m|blog)\.", "").alias("domain")).distinct()


SEEDS_SQL = """seeds AS (SELECT DISTINCT regexp_replace(regexp_extract(url, '^[a-z]+://([^/?#]*)', 1),
  '^(www|m|blog)\\.', '') AS domain FROM pages WHERE starts_with(url, 'https://'))"""


def index_semi_join(spark, sf_dir):
    return index.for_domains(captures(spark, sf_dir), seeds(spark, sf_dir))


def seed_hits(spark, sf_dir):
    wanted = seeds(spark, sf_dir)
    return index.seed_hits(wanted, index.for_domains(page_index(spark, sf_dir), wanted))


def index_dedupe(spark, sf_dir):
    return dedupe.latest_captures(captures(spark, sf_dir))


def keep_first(spark, sf_dir):
    return dedupe.keep_first(captures(spark, sf_dir), ["url_path"], ["warc_record_offset"])


def _old(spark, sf_dir):
    return captures(spark, sf_dir).where(F.col("crawl") < "CC-MAIN-2024-26")


def _new(spark, sf_dir):
    return captures(spark, sf_dir).where(F.col("crawl") > "CC-MAIN-2024-10")


def index_upsert(spark, sf_dir):
    return index.merge_index(_old(spark, sf_dir), _new(spark, sf_dir))


def index_rows_added(spark, sf_dir):
    return index.rows_added(_old(spark, sf_dir), index_upsert(spark, sf_dir))


def crawl_calendar(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(F.year("o_orderdate").alias("order_year"))
    known = orders.withColumn("year", F.col("order_year") + 26)
    counted = known.groupBy("year").agg(F.count(F.lit(1)).alias("orders"))
    joined = index.crawls_of_years(spark, counted, "year")
    return joined.select("year", "orders", F.explode("crawls").alias("crawl"))


_CALENDAR_VALUES = ", ".join(
    f"({y}, '{fixed.CRAWL_PREFIX}{y}-{w}')" for y, weeks in fixed.CRAWL_WEEKS.items() for w in weeks.split())


def normalize_urls(spark, sf_dir):
    found = page_index(spark, sf_dir)
    return found.select("domain", "url_path", normalize_url("domain", "url_path").alias("url"),
                        canonical_link(F.concat(F.lit("http://"), "domain", "url_path")).alias("link"))


def url_hosts(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    return pages.select("page_id", authority("url").alias("netloc"), url_host("url").alias("host"),
                        strip_www(authority("url")).alias("bare_host"))


def registered_domains(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", url_host("url").alias("host"))
    suffixes = spark.createDataFrame([("com",), ("net",), ("org",), ("example.org",)], "suffix string")
    known = registered_domain(pages, "host", "domain_common")
    return registered_domain(known, "host", "domain_listed", suffixes)


def registered_domain_full(spark, sf_dir):
    """Hosts of the customers against a list of nine thousand suffixes with wildcards, exceptions and rules of four labels."""
    n = F.col("id").cast("string")
    base = F.concat(F.lit("s"), n, F.lit(".t"), (F.col("id") % 300).cast("string"))
    rules = F.when(F.col("id") % 3 == 0, F.array(base)).when(
        F.col("id") % 3 == 1, F.array(F.concat(F.lit("*."), base), F.concat(F.lit("!x."), base))).otherwise(F.array(F.concat(F.lit("a.b."), base)))
    suffixes = spark.range(9000).select(F.explode(rules).alias("suffix"))
    key = F.col("c_custkey")
    front = F.element_at(F.array(F.lit("www.shop.d."), F.lit("www.x."), F.lit("www.shop.a.b.")), (F.floor(key / 3) % 3).cast("int") + 1)
    number = key % 9000
    host = F.concat(front, F.lit("s"), number.cast("string"), F.lit(".t"), (number % 300).cast("string"))
    hosts = table(spark, sf_dir, "customer").select(key, host.alias("host"))
    return registered_domain(hosts, "host", "domain", suffixes)


def page_batches(spark, sf_dir):
    return budget.page_batches(page_index(spark, sf_dir), ["url_path", "warc_record_offset"],
                               limits=budget.Limits(batch_size=5)).select(
        "domain", "url_path", "warc_record_offset", "rn", "batch", F.round("progress", 6).alias("progress"))


_ORDER = "md5('0|' || url_path || '|' || warc_record_offset)"


def per_domain_limit(spark, sf_dir):
    return budget.per_domain_limit(captures(spark, sf_dir), 3, ["url_path", "warc_record_offset"]).select(
        "domain", "url_path", "warc_record_offset", "rn", "total")


def _split(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select(
        F.regexp_replace(authority("url"), r"^(www|m|blog)\.", "").alias("domain"),
        F.regexp_replace("url", "^http:", "https:").alias("link"), "url")
    return pages.where(F.col("url").startswith("https:")), pages


def live_anti_join(spark, sf_dir):
    archive, live = _split(spark, sf_dir)
    return live_only(live.select("domain", "link"), archive.select("domain", F.col("link").alias("url")))


def archive_plus_live(spark, sf_dir):
    archive, live = _split(spark, sf_dir)
    fresh = live_only(live.select("domain", "link"), archive.select("domain", F.col("link").alias("url")))
    both = archive_and_live(archive.select("domain", "link"), fresh)
    return both.groupBy("domain", "origin").agg(F.count(F.lit(1)).alias("records"))


_SPLIT_SQL = """pages_split AS (SELECT regexp_replace(regexp_extract(url, '^[a-z]+://([^/?#]*)', 1),
  '^(www|m|blog)\\.', '') AS domain, regexp_replace(url, '^http:', 'https:') AS link, url FROM pages),
fresh AS (SELECT domain, link FROM pages_split p WHERE NOT EXISTS (
  SELECT 1 FROM pages_split a WHERE starts_with(a.url, 'https:') AND a.link = p.link AND a.domain = p.domain))"""


def final_url_check(spark, sf_dir):
    """Pages that are still on the domain that was asked for: one domain per language folder."""
    pages = table(spark, sf_dir, "pages")
    asked = F.when(F.col("url").contains("/en/"), "example.com").otherwise("example.org")
    return on_asked_domain(pages.select("page_id", "url", asked.alias("domain")), "url")


def _visits(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return events.select(F.col("user_id").cast("string").alias("domain"), F.col("event_id").cast("string").alias("url_path"),
                         F.array(F.concat_ws("-", "event_type", F.get_json_object("props", "$.k"))).alias("technologies"))


def novelty_streak(spark, sf_dir):
    return budget.novelty_streak(_visits(spark, sf_dir)).select(
        "domain", "url_path", "rn", "streak", F.col("known").cast("long").alias("known"), "paused")


def page_budget(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    visits = events.select(
        F.concat(F.lit("site"), (F.col("user_id") % 7).cast("string")).alias("domain"),
        F.col("event_id").cast("string").alias("url_path"),
        ((F.col("event_type") == "purchase") & (F.col("value") > 10 * (F.col("user_id") % 7))).alias("is_product"))
    limits = budget.Limits(batch_size=5, max_pages=600, max_products=40, relevance_check=60, relevance_threshold=8.0)
    return budget.page_budget(visits, limits=limits).select("domain", "url_path", "rn", "batch", "needs_live")


QUERIES = {f.__name__: f for f in (
    index_lookup, suffix_filter, index_semi_join, seed_hits, index_dedupe, keep_first, index_upsert, index_rows_added,
    crawl_calendar, registered_domains, registered_domain_full, page_batches, per_domain_limit, live_anti_join, archive_plus_live,
    novelty_streak, page_budget, final_url_check)}
QUERIES["normalize_url"] = normalize_urls
QUERIES["url_host"] = url_hosts

_SIX = "domain, crawl, url_path, warc_filename, warc_record_offset, warc_record_length"

ORACLES = {
    "index_lookup": f"WITH {CAPTURES_SQL} SELECT {_SIX} FROM captures WHERE domain IN "
                    f"({', '.join(repr(d) for d in LOOKUP_DOMAINS)}) AND crawl IN "
                    f"({', '.join(repr(c) for c in LOOKUP_CRAWLS)})",
    "suffix_filter": f"WITH {PAGE_INDEX_SQL} SELECT domain, url_path FROM page_index WHERE NOT ("
                     + " OR ".join(f"ends_with(url_path, '{s}')" for s in fixed.FILE_SUFFIXES) + ")",
    "index_semi_join": f"WITH {CAPTURES_SQL}, {SEEDS_SQL} SELECT {_SIX} FROM captures "
                       "WHERE domain IN (SELECT domain FROM seeds)",
    "seed_hits": f"WITH {PAGE_INDEX_SQL}, {SEEDS_SQL} SELECT s.domain, count(i.domain) AS archive_record_count_unique "
                 "FROM seeds s LEFT JOIN page_index i ON i.domain = s.domain GROUP BY s.domain",
    "index_dedupe": f"WITH {CAPTURES_SQL} SELECT {_SIX} FROM captures QUALIFY row_number() OVER "
                    "(PARTITION BY domain, url_path ORDER BY crawl DESC, warc_record_offset DESC) = 1",
    "keep_first": f"WITH {CAPTURES_SQL} SELECT {_SIX} FROM captures QUALIFY row_number() OVER "
                  "(PARTITION BY url_path ORDER BY warc_record_offset) = 1",
    "index_upsert": f"WITH {CAPTURES_SQL} SELECT {_SIX} FROM captures WHERE crawl < 'CC-MAIN-2024-26' UNION "
                    f"SELECT {_SIX} FROM captures WHERE crawl > 'CC-MAIN-2024-10'",
    "index_rows_added": f"WITH {CAPTURES_SQL}, old AS (SELECT * FROM captures WHERE crawl < 'CC-MAIN-2024-26'), "
                        "merged AS (SELECT * FROM old UNION SELECT * FROM captures WHERE crawl > 'CC-MAIN-2024-10') "
                        "SELECT (SELECT count(*) FROM old) AS rows_before, (SELECT count(*) FROM merged) AS rows_after, "
                        "(SELECT count(*) FROM merged) - (SELECT count(*) FROM old) AS rows_added",
    "crawl_calendar": f"WITH calendar(year, crawl) AS (VALUES {_CALENDAR_VALUES}), "
                      "counted AS (SELECT CAST(year(o_orderdate) + 26 AS INTEGER) AS year, count(*) AS orders "
                      "FROM orders GROUP BY 1) "
                      "SELECT o.year, o.orders, c.crawl FROM counted o JOIN calendar c ON c.year = "
                      f"(CASE WHEN o.year IN (SELECT year FROM calendar) THEN o.year ELSE {fixed.DEFAULT_YEAR} END)",
    "normalize_url": f"WITH {PAGE_INDEX_SQL} SELECT domain, url_path, "
                     "regexp_replace(regexp_replace('https://' || domain || url_path, '/+$', ''), '(\\?.+)|(#.+)', '', 'g') AS url, "
                     "replace(regexp_replace('http://' || domain || url_path, '(\\?.+)|(#.+)', '', 'g'), ' ', '') AS link "
                     "FROM page_index",
    "url_host": "SELECT page_id, split_part(url, '/', 3) AS netloc, split_part(url, '/', 3) AS host, "
                "regexp_replace(split_part(url, '/', 3), '^www\\.', '') AS bare_host FROM pages",
    "final_url_check": "WITH asked AS (SELECT page_id, url, CASE WHEN contains(url, '/en/') THEN 'example.com' ELSE 'example.org' END "
                       "AS domain FROM pages) SELECT page_id, url, domain FROM asked WHERE ends_with(split_part(url, '/', 3), '.' || domain)",
    "page_batches": f"WITH {PAGE_INDEX_SQL}, ranked AS (SELECT *, row_number() OVER (PARTITION BY domain ORDER BY "
                    f"{_ORDER}) AS rn, count(*) OVER (PARTITION BY domain) AS total FROM page_index) "
                    "SELECT domain, url_path, warc_record_offset, rn, CAST((rn - 1) // 5 AS BIGINT) AS batch, "
                    "round(rn * 100.0::DOUBLE / total, 6) AS progress FROM ranked",
    "per_domain_limit": f"WITH {CAPTURES_SQL}, ranked AS (SELECT *, row_number() OVER (PARTITION BY domain ORDER BY "
                        f"{_ORDER}) AS rn, count(*) OVER (PARTITION BY domain) AS total FROM captures) "
                        "SELECT domain, url_path, warc_record_offset, rn, total FROM ranked WHERE rn <= 3",
    "live_anti_join": f"WITH {_SPLIT_SQL} SELECT domain, link FROM fresh",
    "archive_plus_live": f"WITH {_SPLIT_SQL}, everything AS (SELECT domain, 'archive' AS origin FROM pages_split "
                         "WHERE starts_with(url, 'https:') UNION ALL SELECT domain, 'live' FROM fresh) "
                         "SELECT domain, origin, count(*) AS records FROM everything GROUP BY ALL",
    "novelty_streak": """
WITH visits AS (
  SELECT CAST(user_id AS VARCHAR) AS domain, CAST(event_id AS VARCHAR) AS url_path,
         event_type || '-' || json_extract_string(props, '$.k') AS tech FROM events),
ranked AS (SELECT *, row_number() OVER (PARTITION BY domain ORDER BY md5('0|' || url_path), url_path) AS rn FROM visits),
marked AS (SELECT *, row_number() OVER (PARTITION BY domain, tech ORDER BY rn) = 1 AS fresh FROM ranked),
counted AS (SELECT *, max(CASE WHEN fresh THEN rn END) OVER w AS last_new,
            count(CASE WHEN fresh THEN 1 END) OVER w AS known FROM marked
            WINDOW w AS (PARTITION BY domain ORDER BY rn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT domain, url_path, rn, rn - coalesce(last_new, 0) AS streak, known,
       rn - coalesce(last_new, 0) > 5 AS paused FROM counted""",
    "page_budget": """
WITH visits AS (
  SELECT 'site' || (user_id % 7) AS domain, CAST(event_id AS VARCHAR) AS url_path,
         event_type = 'purchase' AND value > 10 * (user_id % 7) AS is_product FROM events),
ranked AS (SELECT *, row_number() OVER (PARTITION BY domain ORDER BY md5('0|' || url_path), url_path) AS rn FROM visits),
batched AS (SELECT *, CAST((rn - 1) // 5 AS BIGINT) AS batch FROM ranked),
sums AS (SELECT domain, batch, count(*) AS p, count(CASE WHEN is_product THEN 1 END) AS c FROM batched GROUP BY ALL),
running AS (SELECT domain, batch, sum(p) OVER w AS p, sum(c) OVER w AS c FROM sums
            WINDOW w AS (PARTITION BY domain ORDER BY batch)),
stops AS (SELECT domain, min(batch) AS last FROM running WHERE p > 600 OR c > 40 OR (p >= 40 AND c = 0)
          OR (p >= 60 AND c * 100.0 / p < 8.0) GROUP BY domain)
SELECT b.domain, b.url_path, b.rn, b.batch, s.last IS NULL AS needs_live
FROM batched b LEFT JOIN stops s ON s.domain = b.domain WHERE s.last IS NULL OR b.batch <= s.last""",
}
QUERIES["registered_domain"] = QUERIES.pop("registered_domains")
ORACLES["registered_domain_full"] = """
WITH c AS (SELECT c_custkey, c_custkey % 9000 AS n, (c_custkey // 3) % 3 AS f, 's' || (c_custkey % 9000) || '.t' || (c_custkey % 9000 % 300) AS base FROM customer)
SELECT c_custkey, (CASE f WHEN 0 THEN 'www.shop.d.' WHEN 1 THEN 'www.x.' ELSE 'www.shop.a.b.' END) || base AS host,
       CASE n % 3 WHEN 0 THEN (CASE f WHEN 0 THEN 'd.' WHEN 1 THEN 'x.' ELSE 'b.' END) || base
                  WHEN 1 THEN (CASE f WHEN 0 THEN 'shop.d.' WHEN 1 THEN 'x.' ELSE 'a.b.' END) || base
                  ELSE (CASE f WHEN 2 THEN 'shop.a.b.' ELSE '' END) || base END AS domain FROM c"""
ORACLES["registered_domain"] = """
WITH hosts AS (SELECT page_id, split_part(url, '/', 3) AS host FROM pages)
SELECT page_id, host, regexp_extract(host, '[^.]+\\.[^.]+$') AS domain_common,
       CASE WHEN ends_with(host, '.example.org') THEN regexp_extract(host, '[^.]+\\.[^.]+\\.[^.]+$')
            ELSE regexp_extract(host, '[^.]+\\.[^.]+$') END AS domain_listed FROM hosts"""
