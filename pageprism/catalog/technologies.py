"""Registered queries over technology rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from pageprism.catalog.frames import SHOP_SQL, shop_pages, table
from pageprism.functions.headers import parse_headers
from pageprism.functions.urls import url_host
from pageprism.operators import rule_index, technology as t
from pageprism.operators.products import with_tokens
from pageprism.operators.rows import spread, unnest
from pageprism.operators.rules import split_pattern
from pageprism.sources.rule_files import sample_rules


def _pages(spark, sf_dir):
    pages = with_tokens(spread(table(spark, sf_dir, "pages")))
    return pages.withColumn("headers", F.lit(None).cast("map<string,array<string>>"))


def _shop(spark, sf_dir):
    shop = with_tokens(shop_pages(spark, sf_dir).withColumnRenamed("response", "html"))
    return shop.withColumns({"headers": parse_headers("header"), "url": F.concat(F.lit("https://"), "domain", "url_path")})


def rule_parse(spark, sf_dir):
    """Rule patterns with version and confidence tags, one per part."""
    part = table(spark, sf_dir, "part")
    tag = F.when(F.col("p_size") % 2 == 0, F.concat(F.lit(r"\;confidence:"), "p_size")).otherwise("")
    raw = F.concat(F.col("p_type"), F.lit(r"-([\d.]+)\;version:\1?"), "p_name", F.lit(":none"), tag)
    return part.select("p_partkey", *[c.alias(n) for n, c in split_pattern(raw).items()])


def tech_html(spark, sf_dir):
    """URL and page-text rules on the given pages."""
    rules = sample_rules(spark)
    pages = _pages(spark, sf_dir).withColumn("lowered", F.lower("html"))
    return unnest(pages, ["page_id"], t.html_hits(rules, lowered="lowered"), "h").select(
        "page_id", "h.technology", "h.version", "h.confidence")


def tech_headers(spark, sf_dir):
    return unnest(_shop(spark, sf_dir), ["page_id"], t.header_hits(sample_rules(spark)), "h").select(
        "page_id", "h.technology", "h.version", "h.confidence")


def tech_dom(spark, sf_dir):
    """Selector rules on the given pages, those on text and on nested elements included."""
    rules = sample_rules(spark)
    pages = t.with_tree(_pages(spark, sf_dir), rules)
    return unnest(pages, ["page_id"], t.element_hits(rules, tree="tree"), "h").select("page_id", "h.technology", "h.version")


def tech_meta(spark, sf_dir):
    """Meta-tag and script-source rules on the shop pages."""
    pages = _shop(spark, sf_dir).withColumns({"metas": t.meta_map("tokens"), "sources": t.script_sources("tokens")})
    return unnest(pages, ["page_id"], t.meta_hits(sample_rules(spark)), "h").select(
        "page_id", "h.technology", "h.version")


def tech_confidence(spark, sf_dir):
    """Total confidence per page and technology."""
    found = t.page_technologies(_shop(spark, sf_dir), sample_rules(spark))
    return t.detected(found, ["page_id"]).select("page_id", "technology", "confidence")


def tech_per_domain(spark, sf_dir):
    found = t.page_technologies(_pages(spark, sf_dir).withColumn("domain", url_host("url")), sample_rules(spark))
    return t.detected(found, ["domain"]).select("domain", "technology", "version")


def tech_implied(spark, sf_dir):
    rules = sample_rules(spark)
    found = t.detected(t.page_technologies(_shop(spark, sf_dir), rules), ["domain"])
    return t.with_implied(found, rules.implies, ["domain"])


def tech_categories(spark, sf_dir):
    rules = sample_rules(spark)
    found = t.with_implied(t.detected(t.page_technologies(_shop(spark, sf_dir), rules), ["domain"]), rules.implies, ["domain"])
    return t.with_categories(found, rules.tech_categories).select(
        "domain", "technology", F.array_join("categories", "|").alias("categories"))


def _numbered_rules(spark, n):
    """Rule table of ``n`` numbers: one rule on the text of a page, with a version, and one on its address, for even numbers."""
    number = F.col("id").cast("string")
    def row(letter, field, pattern, template):
        return F.struct(F.concat(F.lit(letter), number).alias("tech"), F.lit(field).alias("field"), pattern.alias("pattern"),
                        F.lit(template).cast("string").alias("version_tpl"))

    rows = F.array(row("R", "html", F.concat(F.lit("/p/"), number, F.lit(r"/next\?x=(\d)#")), r"\1?v\1:none"),
                   row("U", "url", F.when(F.col("id") % 2 == 0, F.concat(F.lit("/about/"), number, F.lit("$"))), None),
                   row("X", "html", F.when(F.col("id") % 50 == 0, F.lit("(broken")), None))
    rules = spark.range(n).select(F.explode(rows).alias("r")).select("r.*").withColumns(
        {"key": F.lit(""), "selector": F.lit(""), "confidence": F.lit(100)}).where("pattern IS NOT NULL")
    return rule_index.indexable(rules)


def tech_indexed(spark, sf_dir):
    """Four hundred rules and more, a fiftieth of them broken, by the index of their texts."""
    return rule_index.matches(_shop(spark, sf_dir), _numbered_rules(spark, 400))


def tech_many_rules(spark, sf_dir):
    """Two hundred thousand rules by the index of their texts."""
    return rule_index.matches(_shop(spark, sf_dir), _numbered_rules(spark, 200_000)).where("technology LIKE 'R%'")


QUERIES = {f.__name__: f for f in (
    rule_parse, tech_html, tech_headers, tech_dom, tech_meta, tech_confidence, tech_per_domain, tech_implied,
    tech_categories, tech_indexed, tech_many_rules)}

_HEADER_SQL = """
  SELECT k, domain, CASE WHEN k % 2 = 0 THEN 'Nginx' ELSE 'Apache HTTP Server' END AS technology,
         CASE WHEN k % 2 = 0 THEN '1.' || (k % 10) || '.0' END AS version, 100 AS confidence FROM shop
  UNION ALL SELECT k, domain, 'Session cookie', NULL, 40 FROM shop WHERE k % 5 = 0"""
SHOP_TECH_SQL = f"""
shop_tech AS ({_HEADER_SQL}
  UNION ALL SELECT k, domain, 'WordPress', '6.' || (k % 9), 100 FROM shop
  UNION ALL SELECT k, domain, 'jQuery', '3.' || (k % 8) || '.1', 100 FROM shop
  UNION ALL SELECT k, domain, 'JSON-LD', NULL, 100 FROM shop WHERE k % 4 = 0
  UNION ALL SELECT k, domain, 'Open Graph', NULL, 100 FROM shop WHERE k % 4 = 1
  UNION ALL SELECT k, domain, 'Microdata', 'Product', 100 FROM shop WHERE k % 4 = 2),
found AS (SELECT domain, technology, max(version) AS version FROM shop_tech GROUP BY ALL),
implied AS (
  SELECT domain, technology, version FROM found
  UNION ALL SELECT domain, unnest(['PHP', 'MySQL']), NULL FROM found WHERE technology = 'WordPress')"""
_DOM_SQL = """
  SELECT page_id, 'Ad slot' AS technology, NULL AS version FROM pages WHERE contains(html, '<div class="ad">')
  UNION ALL SELECT page_id, 'Navigation list', NULL FROM pages WHERE regexp_matches(html, '<nav><ul>.*<a href="/')
  UNION ALL SELECT page_id, 'Footer credits', regexp_extract(html, '(?s)<footer>.*?\\b(example\\.(com|net|org))\\b', 1)
  FROM pages WHERE regexp_matches(html, '(?s)<footer>.*\\bexample\\.(com|net|org)\\b')"""
_PAGE_HTML_SQL = """
  SELECT page_id, 'Tracking call' AS technology, regexp_extract(html, 'track\\((\\d+)\\);', 1) AS version, 60 AS confidence
  FROM pages WHERE regexp_matches(html, 'track\\(\\d+\\);')
  UNION ALL SELECT page_id, 'PHP', NULL, 100 FROM pages WHERE regexp_matches(url, '\\.php($|\\?)')"""
CATEGORY_NAMES = {
    "Apache HTTP Server": "Web servers", "Nginx": "Web servers", "Session cookie": "Programming languages",
    "PHP": "Programming languages", "MySQL": "Databases", "WordPress": "CMS|Blogs", "jQuery": "JavaScript libraries",
    "Open Graph": "Structured data", "Microdata": "Structured data", "JSON-LD": "Structured data",
}
CATEGORY_SQL = "names(technology, categories) AS (VALUES " + ", ".join(
    f"('{k}', '{v}')" for k, v in CATEGORY_NAMES.items()) + ")"

ORACLES = {
    "tech_indexed": f"""WITH {SHOP_SQL} SELECT k AS page_id, 'R' || k AS technology, 'v1' AS version, 100 AS confidence, 'html' AS field FROM shop WHERE k < 400
      UNION ALL SELECT k, 'U' || k, NULL, 100, 'url' FROM shop WHERE k % 3 = 2 AND k % 2 = 0 AND k < 400""",
    "tech_many_rules": f"WITH {SHOP_SQL} SELECT k AS page_id, 'R' || k AS technology, 'v1' AS version, 100 AS confidence, 'html' AS field FROM shop WHERE k < 200000",
    "rule_parse": "SELECT p_partkey, p_type || '-([\\d.]+)' AS pattern, '\\1?' || p_name || ':none' AS version_tpl, "
                  "CASE WHEN p_size % 2 = 0 THEN p_size ELSE 100 END AS confidence FROM part",
    "tech_html": _PAGE_HTML_SQL,
    "tech_headers": f"WITH {SHOP_SQL} SELECT k AS page_id, technology, version, confidence FROM ({_HEADER_SQL})",
    "tech_dom": _DOM_SQL,
    "tech_meta": f"WITH {SHOP_SQL} SELECT k AS page_id, 'WordPress' AS technology, '6.' || (k % 9) AS version FROM shop "
                 "UNION ALL SELECT k, 'jQuery', '3.' || (k % 8) || '.1' FROM shop",
    "tech_confidence": f"WITH {SHOP_SQL}, {SHOP_TECH_SQL} SELECT k AS page_id, technology, CAST(sum(confidence) AS BIGINT) "
                       "AS confidence FROM shop_tech GROUP BY ALL",
    "tech_per_domain": f"""WITH rows AS (SELECT page_id, technology, version FROM ({_DOM_SQL})
        UNION ALL SELECT page_id, technology, version FROM ({_PAGE_HTML_SQL}))
      SELECT split_part(url, '/', 3) AS domain, technology, max(version) AS version
      FROM rows JOIN pages USING (page_id) GROUP BY ALL""",
    "tech_implied": f"WITH {SHOP_SQL}, {SHOP_TECH_SQL} SELECT domain, technology, max(version) AS version FROM implied GROUP BY ALL",
    "tech_categories": f"WITH {SHOP_SQL}, {SHOP_TECH_SQL}, {CATEGORY_SQL} SELECT DISTINCT i.domain, i.technology, n.categories "
                       "FROM implied i JOIN names n USING (technology)",
}
