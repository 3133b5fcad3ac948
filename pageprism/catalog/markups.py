"""Registered queries over shop pages: links, social accounts, markup and prices."""

from __future__ import annotations

from pyspark.sql import functions as F

from pageprism import fixed
from pageprism.catalog.frames import SHOP_SQL, shop_pages, table
from pageprism.functions import markup_text as m
from pageprism.functions.price import html_currency as currency_in, html_price as price_in
from pageprism.functions.text import product_text as text_of
from pageprism.functions.urls import is_product_path
from pageprism.operators import links as l
from pageprism.operators import markup
from pageprism.operators.dedupe import non_null_count
from pageprism.operators.products import page_products, product_rows, with_tokens
from pageprism.operators.rows import spread, unnest, unnest_positions


def _shop(spark, sf_dir):
    return with_tokens(shop_pages(spark, sf_dir).withColumnRenamed("response", "html"))


def _links(spark, sf_dir):
    pages = _shop(spark, sf_dir).select(
        "page_id", "domain", F.concat(F.lit("https://"), "domain", "url_path").alias("url"),
        m.anchors("tokens").alias("links"))
    return l.page_links(pages)


def external_links(spark, sf_dir):
    return l.external_links(_links(spark, sf_dir)).select("page_id", "href")


def external_link_urls(spark, sf_dir):
    return l.distinct_links(l.external_links(_links(spark, sf_dir)))


def external_link_hosts(spark, sf_dir):
    return l.link_hosts(l.external_links(_links(spark, sf_dir)))


def internal_links(spark, sf_dir):
    return l.internal_links(_links(spark, sf_dir)).select("domain", "link").distinct()


def absolute_internal_links(spark, sf_dir):
    return l.internal_links(_links(spark, sf_dir), relative=False).select("domain", "link").distinct()


def social_links(spark, sf_dir):
    return l.social_links(l.external_links(_links(spark, sf_dir)), ["page_id", "pos"])


def html_price(spark, sf_dir):
    return _shop(spark, sf_dir).select("page_id", F.lower("html").alias("low")).select(
        "page_id", price_in("low").alias("price"))


def html_currency(spark, sf_dir):
    return _shop(spark, sf_dir).select("page_id", F.lower("html").alias("low")).select(
        "page_id", currency_in("low").alias("currency"))


def jsonld_products(spark, sf_dir):
    scripts = _shop(spark, sf_dir).select("page_id", m.linked_data("tokens").alias("scripts"))
    found = unnest(scripts, ["page_id"], F.expr(markup.described_products("scripts")), "v")
    fields = found.select("page_id", F.expr(markup.product_fields("v")).alias("f"))
    return fields.select("page_id", F.col("f.product_title").alias("title"), "f.brand", "f.price", "f.currency")


def markup_items(spark, sf_dir):
    items = markup.markup_items(markup.markup_columns(_shop(spark, sf_dir)))
    return items.select("page_id", "syntax", "seq", F.try_variant_get("item", "$['@type']", "string").alias("type"))


def markup_price(spark, sf_dir):
    """Price, currency and brand of every item of the shop pages."""
    items = markup.markup_items(markup.markup_columns(_shop(spark, sf_dir)))
    return items.select("page_id", "syntax", "seq", F.expr(markup.product_fields("item")).alias("f")).select(
        "page_id", "syntax", "seq", "f.price", "f.currency", "f.brand")


def markup_merge(spark, sf_dir):
    merged = markup.merge_markup(markup.markup_columns(_shop(spark, sf_dir)))
    return merged.select("page_id", *markup.FIELDS)


def _described(spark, sf_dir):
    """One JSON-LD text per part, in four shapes: group with variants, graph, page entity and list."""
    part = spread(table(spark, sf_dir, "part"))
    key = F.col("p_partkey").cast("string")

    def product(name, price, kind="Product"):
        return F.concat(
            F.lit(f'{{"@type":"{kind}","name":"'), name, F.lit('","category":"'), F.col("p_type"),
            F.lit('","offers":[{"@type":"AggregateOffer","priceCurrency":"USD","price":'), price,
            F.lit(',"lowPrice":'), F.col("p_size").cast("string"), F.lit(',"highPrice":"'),
            (F.col("p_size") + 100).cast("string"), F.lit('"}]}'))

    own = product(F.col("p_name"), F.col("p_retailprice").cast("decimal(12,2)").cast("string"))
    other = product(F.lit("other"), F.lit("1.00"))
    shapes = [
        F.concat(F.lit('{"@type":"ProductGroup","name":"group","hasVariant":['), own, F.lit(","), other, F.lit("]}")),
        F.concat(F.lit('{"@graph":[{"@type":"WebSite","name":"site"},'), own, F.lit(","), other, F.lit("]}")),
        F.concat(F.lit('{"@type":"ItemPage","mainEntity":'), own, F.lit("}")),
        F.concat(F.lit("["), own, F.lit(","), other, F.lit("]")),
    ]
    text = F.element_at(F.array(*shapes), (F.col("p_partkey") % 4).cast("int") + 1)
    html = F.concat(F.lit('<html><head><script type="application/ld+json">'), text,
                    F.lit("</script><script type='application/ld+json'>{broken</script></head></html>"))
    return with_tokens(part.select(F.col("p_partkey").alias("page_id"), key.alias("key"), html.alias("html")))


def product_group(spark, sf_dir):
    merged = markup.merge_markup(markup.markup_columns(_described(spark, sf_dir)))
    return merged.select("page_id", "product_title", "price", "currency")


def price_bounds(spark, sf_dir):
    """Category, low and high price of every candidate in groups, lists, pages and graphs, in order."""
    items = unnest_positions(markup.markup_columns(_described(spark, sf_dir)), ["page_id"], F.expr(markup.candidates("jsonld")), "pos", "v")
    found = items.select("page_id", "pos", F.expr(markup.product_fields("v")).alias("f"), F.expr(markup.extra_fields("v")).alias("x"))
    return found.select("page_id", "pos", F.col("f.product_title").alias("title"), "x.category", "x.low_price", "x.high_price")


def min_non_null(spark, sf_dir):
    merged = markup.merge_markup(markup.markup_columns(_shop(spark, sf_dir)))
    columns = ["domain", "url_path", *markup.FIELDS]
    return merged.select("page_id", non_null_count(columns).alias("found"), (non_null_count(columns) >= 3).alias("enough"))


def product_text(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    title = F.when(F.col("p_size") % 5 == 0, "Undefined").otherwise(F.col("p_name"))
    about = F.when(F.col("p_size") % 3 == 0, F.lit(" none ")).when(F.col("p_size") % 3 == 1, F.col("p_type"))
    return part.select("p_partkey", text_of(title, about).alias("text"))


def product_url(spark, sf_dir):
    """Product test on five kinds of path per shop page."""
    shop = shop_pages(spark, sf_dir)
    paths = F.array(F.col("url_path"), F.concat(F.lit("/x-p-"), F.col("page_id"), F.lit(".html")),
                    F.lit("/products"), F.concat(F.lit("/prodotto/"), F.col("page_id")),
                    F.concat(F.lit("/a.product.b"), F.col("page_id")))
    return shop.select("page_id", F.posexplode(paths).alias("kind", "path")).select(
        "page_id", "kind", is_product_path("path").alias("product"))


def products(spark, sf_dir):
    return product_rows(page_products(_shop(spark, sf_dir)), [
        "page_id", "url", "detected_language", "product_title", "product_description", "brand", "price", "currency",
        "product_schema"])


QUERIES = {f.__name__: f for f in (
    external_links, external_link_urls, external_link_hosts, internal_links, absolute_internal_links, social_links,
    html_price, html_currency, jsonld_products, markup_items, markup_price, markup_merge, product_group, price_bounds,
    min_non_null, product_text, product_url, products)}

_INTERNAL = "SELECT DISTINCT domain, 'https://' || domain || '/p/' || k || '/next' AS link FROM shop"
HOST_SQL = "regexp_replace(split_part(href, '/', 3), '^www\\.', '')"

ORACLES = {
    "external_links": f"WITH {SHOP_SQL} SELECT k AS page_id, href FROM shop_links",
    "external_link_urls": f"WITH {SHOP_SQL} SELECT DISTINCT domain, href FROM shop_links",
    "external_link_hosts": f"WITH {SHOP_SQL} SELECT domain, {HOST_SQL} AS external_link, count(DISTINCT href) AS count "
                           "FROM shop_links GROUP BY ALL",
    "internal_links": f"WITH {SHOP_SQL} {_INTERNAL} UNION SELECT domain, 'https://' || domain || '/cat/' || (k % 10) || '/' FROM shop",
    "absolute_internal_links": f"WITH {SHOP_SQL} {_INTERNAL}",
    "social_links": f"WITH {SHOP_SQL} SELECT DISTINCT domain, platform AS social_platform, account AS social_link FROM shop",
    "html_price": f"WITH {SHOP_SQL} SELECT k AS page_id, price FROM shop",
    "html_currency": f"WITH {SHOP_SQL} SELECT k AS page_id, 'eur' AS currency FROM shop",
    "jsonld_products": f"WITH {SHOP_SQL} SELECT k AS page_id, p_name AS title, p_brand AS brand, price, 'EUR' AS currency "
                       "FROM shop WHERE k % 4 = 0",
    "markup_items": f"WITH {SHOP_SQL} SELECT k AS page_id, 'jsonld' AS syntax, unnest([0, 1])::INTEGER AS seq, 'Product' AS type "
                    "FROM shop WHERE k % 4 = 0 UNION ALL SELECT k, 'opengraph', 0, 'product' FROM shop WHERE k % 4 = 1 "
                    "UNION ALL SELECT k, 'microdata', 0, 'Product' FROM shop WHERE k % 4 = 2",
    "markup_price": f"""WITH {SHOP_SQL}, i AS (SELECT k, unnest(CASE k % 4 WHEN 0 THEN [0, 1] WHEN 3 THEN [] ELSE [0] END) AS seq FROM shop)
      SELECT k AS page_id, CASE k % 4 WHEN 0 THEN 'jsonld' WHEN 1 THEN 'opengraph' ELSE 'microdata' END AS syntax, CAST(seq AS INTEGER) AS seq, price,
             'EUR' AS currency, p_brand AS brand FROM i JOIN shop USING (k)""",
    "markup_merge": f"WITH {SHOP_SQL}, m AS (SELECT *, k % 4 < 3 AS has FROM shop) SELECT k AS page_id, "
                    "CASE WHEN has THEN p_name END AS product_title, CASE WHEN has THEN about END AS product_description, "
                    "CASE WHEN has THEN p_brand END AS brand, CASE WHEN has THEN price END AS price, "
                    "CASE WHEN has THEN 'EUR' END AS currency FROM m",
    "product_group": "SELECT p_partkey AS page_id, p_name AS product_title, "
                     "CAST(CAST(p_retailprice AS DECIMAL(12,2)) AS DOUBLE) AS price, 'USD' AS currency FROM part",
    "price_bounds": """WITH c AS (SELECT *, unnest(CASE p_partkey % 4 WHEN 0 THEN ['own', 'other'] WHEN 1 THEN ['none', 'site', 'own', 'other']
          WHEN 2 THEN ['none', 'own'] ELSE ['own', 'other', 'own'] END) AS kind,
          unnest(CASE p_partkey % 4 WHEN 0 THEN [0, 1] WHEN 1 THEN [0, 1, 2, 3] WHEN 2 THEN [0, 1] ELSE [0, 1, 2] END) AS pos FROM part)
      SELECT p_partkey AS page_id, CAST(pos AS INTEGER) AS pos, CASE kind WHEN 'own' THEN p_name WHEN 'none' THEN NULL ELSE kind END AS title,
             CASE WHEN kind IN ('own', 'other') THEN p_type END AS category, CASE WHEN kind IN ('own', 'other') THEN CAST(p_size AS DOUBLE) END AS low_price,
             CASE WHEN kind IN ('own', 'other') THEN CAST(p_size + 100 AS DOUBLE) END AS high_price FROM c""",
    "min_non_null": f"WITH {SHOP_SQL} SELECT k AS page_id, CASE WHEN k % 4 < 3 THEN 7 ELSE 2 END AS found, k % 4 < 3 AS enough "
                    "FROM shop",
    "product_text": "SELECT p_partkey, CASE WHEN p_size % 5 = 0 THEN (CASE WHEN p_size % 3 = 1 THEN p_type END) "
                    "WHEN p_size % 3 = 1 THEN p_name || '. ' || p_type ELSE p_name END AS text FROM part",
    "product_url": f"WITH {SHOP_SQL} SELECT k AS page_id, kind::INTEGER AS kind, CASE kind WHEN 0 THEN k % 3 < 2 WHEN 2 THEN FALSE ELSE TRUE END "
                   "AS product FROM shop, unnest([0, 1, 2, 3, 4]) AS t(kind)",
    "products": f"WITH {SHOP_SQL} SELECT k AS page_id, 'https://' || domain || clean_path AS url, lang AS detected_language, "
                "product_title, product_description, brand, price, currency, product_schema FROM shop_products "
                "WHERE product_schema IS NOT NULL",
}
