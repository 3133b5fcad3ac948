"""Input frames of the registered queries, built from the given tables, each with its SQL twin.

``page_index`` reads the URLs of ``pages``. ``shop_pages`` makes one shop page per row of ``part``; the SQL
twin gives the values a page was made from and never sees its HTML.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pageprism.functions.urls import authority, url_path
from pageprism.operators.rows import spread

CRAWLS = ["10", "18", "22", "26"]
LANGUAGES = {
    "en": ("This is the ", " for you and it is here"),
    "de": ("Das ist der ", " für dich und nicht ein"),
    "fr": ("Le ", " est pour vous avec une et les"),
    "es": ("El ", " para las con una y por los"),
    "it": ("Il ", " per gli sono con una della"),
    "nl": ("Het ", " voor een en niet met van op te"),
}
SOCIAL = [
    ("facebook", "https://www.facebook.com/acme", "/", "https://www.facebook.com/acme"),
    ("twitter", "https://twitter.com/acme", "/status/1", "https://twitter.com/acme"),
    ("instagram", "https://www.instagram.com/acme", "/", "https://www.instagram.com/acme"),
    ("youtube", "https://www.youtube.com/channel/UC", "/videos", "https://www.youtube.com/channel/UC"),
    ("tiktok", "https://www.tiktok.com/@acme", "", "https://www.tiktok.com/@acme"),
    ("playstore", "https://play.google.com/store/apps/details?id=acme", "",
     "https://play.google.com/store/apps/details?id=acme"),
    ("appstore", "https://itunes.apple.com/app/acme", "/", "https://itunes.apple.com/app/acme"),
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _crawl(number: Column) -> Column:
    return F.concat(F.lit("CC-MAIN-2024-"), F.element_at(F.array(*[F.lit(c) for c in CRAWLS]), number.cast("int") + 1))


def page_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return pages.select(
        F.regexp_replace(authority("url"), r"^(www|m|blog)\.", "").alias("domain"),
        _crawl(F.col("page_id") % 4).alias("crawl"),
        url_path("url").alias("url_path"),
        F.concat(F.lit("f"), F.col("page_id") % 8).alias("warc_filename"),
        F.col("page_id").alias("warc_record_offset"),
        F.length("html").cast("long").alias("warc_record_length"),
    )


def captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page captured in its crawl and once more in the next one."""
    index = page_index(spark, sf_dir)
    again = index.withColumns({
        "crawl": _crawl((F.col("warc_record_offset") + 1) % 4),
        "warc_record_offset": F.col("warc_record_offset") + 1_000_000,
    })
    return index.union(again)


def _crawl_sql(number: str) -> str:
    cases = " ".join(f"WHEN {i} THEN '{c}'" for i, c in enumerate(CRAWLS))
    return f"'CC-MAIN-2024-' || (CASE {number} {cases} END)"


PAGE_INDEX_SQL = f"""
page_index AS (
  SELECT regexp_replace(regexp_extract(url, '^[a-z]+://([^/?#]*)', 1), '^(www|m|blog)\\.', '') AS domain,
         {_crawl_sql('page_id % 4')} AS crawl,
         regexp_replace(url, '^[a-z]+://[^/?#]*', '') AS url_path,
         'f' || (page_id % 8) AS warc_filename,
         page_id AS warc_record_offset,
         CAST(length(html) AS BIGINT) AS warc_record_length
  FROM pages)"""

CAPTURES_SQL = f"""{PAGE_INDEX_SQL},
captures AS (
  SELECT * FROM page_index
  UNION ALL
  SELECT domain, {_crawl_sql('(warc_record_offset + 1) % 4')} AS crawl, url_path, warc_filename,
         warc_record_offset + 1000000 AS warc_record_offset, warc_record_length
  FROM page_index)"""


def _pick(number: Column, values: list[Column]) -> Column:
    return F.element_at(F.array(*values), number.cast("int") + 1)


def shop_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``page_id, domain, crawl, url_path, response, header`` and locator columns, one page per part."""
    k = F.col("p_partkey")
    text = k.cast("string")
    amount = F.col("p_retailprice").cast("decimal(12,2)")
    shown = amount.cast("string")
    comma = F.replace(shown, F.lit("."), F.lit(","))
    price = _pick(k % 5, [
        shown, comma, F.concat(F.lit("1."), comma), F.concat(F.lit("€ "), shown), F.floor(amount).cast("string")])
    lines = [F.concat(F.lit(a), F.col("p_type"), F.lit(b)) for a, b in LANGUAGES.values()]
    about = _pick(k % 6, lines)
    named = F.floor(k / 4) % 2 == 1
    json_brand = F.when(named, F.concat(F.lit('{"@type":"Brand","name":"'), F.col("p_brand"), F.lit('"}'))).otherwise(
        F.concat(F.lit('"'), F.col("p_brand"), F.lit('"')))
    jsonld = F.concat(
        F.lit('<script type="application/ld+json">{"@context":"https://schema.org","@type":"Product","name":"'),
        F.col("p_name"), F.lit('","description":"'), about, F.lit('","brand":'), json_brand,
        F.lit(',"offers":{"@type":"Offer","price":"'), price, F.lit('","priceCurrency":"EUR"}}</script>'))
    og = F.concat(
        F.lit('<meta property="og:type" content="product"><meta property="og:title" content="'), F.col("p_name"),
        F.lit('"><meta property="og:description" content="'), about,
        F.lit('"><meta property="product:brand" content="'), F.col("p_brand"),
        F.lit('"><meta property="product:price:amount" content="'), price,
        F.lit('"><meta property="product:price:currency" content="EUR">'))
    item_brand = F.when(named, F.concat(
        F.lit('<div itemprop="brand" itemscope itemtype="http://schema.org/Brand"><b itemprop="name">'),
        F.col("p_brand"), F.lit("</b></div>"))).otherwise(
        F.concat(F.lit('<b itemprop="brand">'), F.col("p_brand"), F.lit("</b>")))
    micro = F.concat(
        F.lit('<div itemscope itemtype="http://schema.org/Product"><h2 itemprop="name">'), F.col("p_name"),
        F.lit('</h2><p itemprop="description">'), about, F.lit("</p>"), item_brand,
        F.lit('<div itemprop="offers" itemscope itemtype="http://schema.org/Offer">'
              '<meta itemprop="priceCurrency" content="EUR"><span itemprop="price">'), price,
        F.lit("</span></div></div>"))
    plain = F.concat(F.lit("<p>Price: "), price, F.lit("</p><p>Currency: EUR</p>"))
    domain = F.concat(F.lit("shop"), (k % 20).cast("string"), F.lit(".example.com"))
    path = _pick(k % 3, [
        F.concat(F.lit("/product/"), text), F.concat(F.lit("/p/"), text, F.lit("?ref=x")),
        F.concat(F.lit("/about/"), text)])
    social = _pick(k % 7, [F.concat(F.lit(a), (k % 3).cast("string"), F.lit(b)) for _, a, b, _ in SOCIAL])
    style = k % 4
    html = F.concat(
        F.lit('<!DOCTYPE html><html lang="'), _pick(k % 6, [F.lit(f"{c}-XX") for c in LANGUAGES]),
        F.lit('"><head><meta charset="utf-8"><title>'), F.col("p_name"), F.lit(" &amp; more</title>"),
        F.lit('<meta name="description" content="'), about, F.lit('">'),
        F.lit('<meta name="Generator" content="WordPress 6.'), (k % 9).cast("string"), F.lit('">'),
        F.when(style == 1, og).otherwise(""), F.when(style == 0, jsonld).otherwise(""),
        F.lit('<script src="/js/jquery-3.'), (k % 8).cast("string"), F.lit('.1.min.js"></script>'),
        F.lit('<script>var t = "<a href=\'https://script.example.net/\'>";</script></head><body>'),
        F.lit('<!-- <a href="https://comment.example.net/"> -->'),
        F.when(style == 2, micro).otherwise(""), F.when(style == 3, plain).otherwise(""),
        F.lit('<a href="https://partner'), (k % 7).cast("string"), F.lit('.example.org/x">partner</a>'),
        F.lit('<a class=next href="https://'), domain, F.lit("/p/"), text, F.lit('/next?x=1#f">next</a>'),
        F.lit("<a href='/cat/"), (k % 10).cast("string"), F.lit("/#top'>up</a>"),
        F.lit('<a href="/files/'), text, F.lit('.pdf">sheet</a><a href="mailto:shop@example.com">mail</a>'),
        F.lit('<a href="'), social, F.lit('">follow</a>'),
        F.when(k % 2 == 1, F.concat(F.lit('<a href="https://twitter.com/share?u='), text, F.lit('">share</a>')))
        .otherwise(""),
        F.lit("</body></html>"))
    header = F.concat(
        F.when(k % 11 == 0, "HTTP/1.1 404 Not Found").otherwise("HTTP/1.1 200 OK"),
        F.when(k % 2 == 0, F.concat(F.lit("\r\nServer: nginx/1."), (k % 10).cast("string"), F.lit(".0")))
        .otherwise("\r\nServer: Apache"),
        F.when(k % 5 == 0, F.concat(F.lit("\r\nSet-Cookie: sid="), text, F.lit("\r\nSet-Cookie: theme: dark")))
        .otherwise(""),
        F.lit("\r\nContent-Type: text/html; charset=utf-8"))
    return spread(table(spark, sf_dir, "part")).select(
        k.alias("page_id"), domain.alias("domain"), _crawl(k % 4).alias("crawl"), path.alias("url_path"),
        html.alias("response"), header.alias("header"),
        F.lit("parts").alias("warc_filename"), k.alias("warc_record_offset"),
        F.lit(1).cast("long").alias("warc_record_length"))


def _language_sql(number: str, values: list[str]) -> str:
    cases = " ".join(f"WHEN {i} THEN {v}" for i, v in enumerate(values))
    return f"(CASE {number} {cases} END)"


def social_sql(part: int) -> str:
    """SQL for one part of the social link of a page: 0 platform, 1 the link itself, 2 the account."""
    values = {
        0: [f"'{p}'" for p, *_ in SOCIAL],
        1: [f"'{a}' || (k % 3) || '{b}'" for _, a, b, _ in SOCIAL],
        2: [f"'{c}' || (k % 3)" for *_, c in SOCIAL],
    }[part]
    return _language_sql("k % 7", values)


_ABOUT = _language_sql("k % 6", [f"'{a}' || p_type || '{b}'" for a, b in LANGUAGES.values()])
_LANG = _language_sql("k % 6", [f"'{c}'" for c in LANGUAGES])

SHOP_SQL = f"""
raw_shop AS (SELECT p_partkey AS k, * FROM part),
shop AS (
  SELECT k, p_name, p_brand,
         'shop' || (k % 20) || '.example.com' AS domain,
         CASE k % 3 WHEN 0 THEN '/product/' || k WHEN 1 THEN '/p/' || k || '?ref=x' ELSE '/about/' || k END AS url_path,
         CASE k % 3 WHEN 0 THEN '/product/' || k WHEN 1 THEN '/p/' || k ELSE '/about/' || k END AS clean_path,
         {_crawl_sql('k % 4')} AS crawl,
         {_ABOUT} AS about,
         {_LANG} AS lang,
         CAST(CASE k % 5 WHEN 2 THEN CAST(p_retailprice AS DECIMAL(12,2)) + 1000
                         WHEN 4 THEN floor(CAST(p_retailprice AS DECIMAL(12,2)))
                         ELSE CAST(p_retailprice AS DECIMAL(12,2)) END AS DOUBLE) AS price,
         {social_sql(0)} AS platform, {social_sql(1)} AS social, {social_sql(2)} AS account
  FROM raw_shop),
shop_links AS (
  SELECT k, domain, 'https://partner' || (k % 7) || '.example.org/x' AS href FROM shop
  UNION ALL SELECT k, domain, social FROM shop
  UNION ALL SELECT k, domain, 'https://twitter.com/share?u=' || k FROM shop WHERE k % 2 = 1),
shop_products AS (
  SELECT *, CASE WHEN k % 4 < 3 THEN TRUE WHEN k % 3 < 2 THEN FALSE END AS product_schema,
         CASE WHEN k % 4 < 3 THEN p_name WHEN k % 3 < 2 THEN p_name || ' & more' END AS product_title,
         CASE WHEN k % 4 < 3 OR k % 3 < 2 THEN about END AS product_description,
         CASE WHEN k % 4 < 3 THEN p_brand END AS brand,
         CASE WHEN k % 4 < 3 THEN 'EUR' WHEN k % 3 < 2 THEN 'eur' END AS currency
  FROM shop)"""
