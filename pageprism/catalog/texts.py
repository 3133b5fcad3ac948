"""Registered queries over page texts and headers."""

from __future__ import annotations

from pyspark.sql import functions as F

from pageprism import fixed
from pageprism.catalog.frames import SHOP_SQL, shop_pages, table
from pageprism.functions import markup_text as m
from pageprism.functions.headers import header_text, parse_headers, status_code
from pageprism.functions.price import clean_price as price_of
from pageprism.functions.charset import declared_charset as charset_of, with_text
from pageprism.functions.text import (
    clean_text as cleaned, is_translatable, strip_html as stripped, translation_input, unescape_html as unescaped,
)
from pageprism.functions.urls import url_host
from pageprism.operators.classify import predict, train
from pageprism.operators.elements import page_elements as elements_of
from pageprism.operators.language import detect_language, learn_profile, score_languages
from pageprism.operators.links import internal_links
from pageprism.session import checkpointed
from pageprism.operators.rows import spread, unnest, unnest_positions


_BLOCK = "(?s)<(?:title|h1|p|li)>.*?</(?:title|h1|p|li)>"


def _pages(spark, sf_dir):
    return spread(table(spark, sf_dir, "pages"))


def _tokens(spark, sf_dir):
    return _pages(spark, sf_dir).withColumn("tokens", m.tokens("html"))


def page_head(spark, sf_dir):
    return _tokens(spark, sf_dir).select("page_id", m.page_head("tokens").alias("h")).select("page_id", "h.*")


def meta_map(spark, sf_dir):
    """Named meta tags of the shop pages; the given pages have none."""
    shop = shop_pages(spark, sf_dir).withColumn("tokens", m.tokens("response"))
    return shop.select("page_id", F.explode(m.meta_map("tokens")).alias("name", "content"))


def page_links(spark, sf_dir):
    return unnest_positions(_tokens(spark, sf_dir), ["page_id"], m.anchors("tokens"), "pos", "href")


def script_sources(spark, sf_dir):
    shop = shop_pages(spark, sf_dir).withColumn("tokens", m.tokens("response"))
    return unnest(shop, ["page_id"], m.script_sources("tokens"), "src")


def page_elements(spark, sf_dir):
    """Elements per page and tag."""
    found = elements_of(_pages(spark, sf_dir))
    return found.groupBy("page_id", "tag").agg(F.count(F.lit(1)).alias("elements"))


def page_tokens(spark, sf_dir):
    """Start tags per page and tag, counted inside the JVM."""
    found = unnest(_tokens(spark, sf_dir), ["page_id"], F.col("tokens"), "t")
    tag = F.lower(F.regexp_extract("t", r"^<([a-zA-Z][^\s/>]*)", 1))
    return found.groupBy("page_id", tag.alias("tag")).agg(F.count(F.lit(1)).alias("elements"))


def followed_links(spark, sf_dir):
    """Links a crawler would follow from the given pages."""
    pages = _tokens(spark, sf_dir).withColumn("domain", url_host("url"))
    links = unnest_positions(pages, ["domain", "url"], m.anchors("tokens"), "pos", "href")
    return internal_links(links)


def strip_html(spark, sf_dir):
    return _pages(spark, sf_dir).select("page_id", F.md5(stripped("html").cast("binary")).alias("digest"),
                                        F.length(stripped("html")).cast("long").alias("chars"))


def clean_text(spark, sf_dir):
    """Every title, heading, paragraph and list item of a page, cleaned."""
    blocks = unnest_positions(_pages(spark, sf_dir), ["page_id"], F.expr(f"regexp_extract_all(html, '{_BLOCK}', 0)"), "pos", "block")
    return blocks.select("page_id", "pos", cleaned("block").alias("text"))


def html_unescape(spark, sf_dir):
    return _pages(spark, sf_dir).select("page_id", F.md5(unescaped("html").cast("binary")).alias("digest"))


def clean_price(spark, sf_dir):
    """Prices of all parts in seven notations."""
    part = table(spark, sf_dir, "part")
    shown = F.col("p_retailprice").cast("decimal(12,2)").cast("string")
    comma = F.replace(shown, F.lit("."), F.lit(","))

    def form(name, text):
        return F.struct(F.lit(name).alias("form"), text.alias("text"))

    forms = F.array(
        form("dot", shown),
        form("comma", comma),
        form("thousand dot", F.concat(F.lit("1."), comma)),
        form("thousand comma", F.concat(F.lit("1,"), shown)),
        form("million", F.concat(F.lit("2.001."), comma)),
        form("sign", F.concat(F.lit("€ "), shown)),
        form("spaced", F.concat(F.lit("1'0 "), comma, F.lit(" EUR"))),
        form("abbreviation", F.concat(F.lit("Fr. "), shown)),
    )
    rows = part.select("p_partkey", F.explode(forms).alias("f"))
    return rows.select("p_partkey", "f.form", price_of("f.text").alias("price"))


def parse_header_blocks(spark, sf_dir):
    shop = shop_pages(spark, sf_dir).withColumn("headers", parse_headers("header"))
    return shop.select(
        "page_id", status_code("headers").alias("status"),
        F.array_join(F.try_element_at("headers", F.lit("server")), "|").alias("server"),
        F.array_join(F.try_element_at("headers", F.lit("set-cookie")), "|").alias("cookies"),
        header_text(F.map_filter("headers", lambda k, v: k != "status")).alias("rendered"))


def answered_pages(spark, sf_dir):
    """Pages per domain that were answered with status 200."""
    shop = shop_pages(spark, sf_dir).withColumn("headers", parse_headers("header"))
    return shop.where(status_code("headers") == 200).groupBy("domain").agg(F.count(F.lit(1)).alias("answered"))


def declared_charset(spark, sf_dir):
    pages = with_text(_pages(spark, sf_dir).withColumn("data", F.encode("html", "UTF-8")), "data", "text")
    return pages.select("page_id", charset_of("html").alias("charset"), (F.col("text") == F.col("html")).alias("same"))


#: Alphabets by doc_id: the letters a to z become so many letters from a code point on; null for a script whose language isn't known.
_ALPHABETS = [("ru", 0x430), ("el", 0x3B1), ("ja", 0x3042), ("ko", 0xAC00), ("he", 0x5D0), ("zh", 0x4E00), ("th", 0xE01), ("ka", 0x10D0), (None, 0x13A0)]


def _alphabet(first: int) -> str:
    """Letters from a code point on, as many as a to z; short alphabets begin anew."""
    size = {0x3B1: 17, 0x5D0: 27}.get(first, 26)
    return "".join(chr(first + i % size) for i in range(26))


def language_scripts(spark, sf_dir):
    """Languages of documents that are written in other alphabets."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.regexp_replace("text", "[^a-z ]", "").alias("plain")).where("plain RLIKE '[a-z]'")
    text = F.col("plain")
    for i, (_, first) in enumerate(_ALPHABETS):
        text = F.when(F.col("doc_id") % len(_ALPHABETS) == i, F.translate("plain", "abcdefghijklmnopqrstuvwxyz", _alphabet(first))).otherwise(text)
    return docs.select("doc_id", text.alias("text")).select("doc_id", detect_language("text").alias("lang"))


def language_id(spark, sf_dir):
    """Language of every document by function words, and whether it can be translated."""
    docs = spread(table(spark, sf_dir, "documents"))
    found = docs.select("doc_id", detect_language("text").alias("detected"), "text")
    return found.select("doc_id", "detected", is_translatable("detected").alias("translatable"),
                        F.length(translation_input("detected", "text")).cast("long").alias("chars"))


def _held_out():
    """A fifth of all documents, from which no model learns."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0


def language_profile(spark, sf_dir):
    """Language of every document by n-gram profiles that are learned from the labelled documents outside the
    held-out fifth."""
    docs = spread(table(spark, sf_dir, "documents"))
    scored = score_languages(docs, checkpointed(learn_profile(docs.where(~_held_out()))), "doc_id")
    return docs.select("doc_id", "lang").join(scored, "doc_id", "left")


def text_classifier(spark, sf_dir):
    """Quality class of every document by a model that is trained on the labelled ones outside the held-out fifth."""
    docs = spread(table(spark, sf_dir, "documents")).select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").cast("double").alias("label"))
    model = train(docs.join(labels, "doc_id").where(~_held_out() & F.col("text").isNotNull() & F.col("label").isNotNull()))
    return predict(model, docs, ["doc_id"], spark.createDataFrame(QUALITY, "id int, literal string"))


def language_quality(spark, sf_dir):
    """Of the learned profiles: documents, and whether at least 85 % of the held-out ones get their own language."""
    right = F.when(_held_out() & F.col("lang").isNotNull(), (F.coalesce("lang_detected", F.lit("")) == F.col("lang")).cast("int"))
    return language_profile(spark, sf_dir).agg(
        F.count(F.lit(1)).alias("documents"), (F.avg(right) >= 0.85).alias("accurate"))


def classifier_quality(spark, sf_dir):
    """Of the classes: documents, whether classes are named and probabilities sound, and whether at least 70 % of the held-out
    labels are met."""
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    both = text_classifier(spark, sf_dir).join(labels, "doc_id", "left")
    right = F.when(_held_out() & F.col("quality").isNotNull(), (F.col("id") == F.col("quality")).cast("int"))
    return both.agg(
        F.count_distinct("doc_id").alias("documents"), F.bool_and(F.col("literal").isNotNull()).alias("named"),
        F.bool_and(F.col("probability").between(0.5, 1.0)).alias("sound"), (F.avg(right) >= 0.7).alias("accurate"))


#: Classes of the label table.
QUALITY = [(0, "low quality"), (1, "high quality")]

QUERIES = {f.__name__: f for f in (
    page_head, meta_map, page_links, script_sources, page_elements, page_tokens, followed_links, strip_html,
    clean_text, html_unescape, clean_price, answered_pages, declared_charset, language_id, language_profile,
    text_classifier, language_quality, classifier_quality, language_scripts)}
QUERIES["parse_headers"] = parse_header_blocks

# Pages without comments, scripts and styles: what is left has markup only where it is markup.
_BARE = """bare AS (SELECT page_id, url, html, regexp_replace(html, '(?s)<!--.*?-->|<script>.*?</script>|<style>.*?</style>',
  '', 'g') AS body FROM pages)"""
_TAGS = """tags AS (
  SELECT page_id, unnest(regexp_extract_all(body, '<([a-zA-Z][a-zA-Z0-9]*)[^>]*>', 1)) AS tag FROM bare
  UNION ALL SELECT page_id, unnest(regexp_extract_all(html, '<(script|style)>', 1)) FROM pages)"""
_UNESCAPED = "replace({0}, '&quot;', '\"')"
for _name, _value in (("&copy;", "©"), ("&middot;", "·"), ("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&")):
    _UNESCAPED = f"replace({_UNESCAPED}, '{_name}', '{_value}')"
_COUNTS = " UNION ALL ".join(
    f"SELECT doc_id, '{lang}' AS lang, len(list_filter(words, lambda w: w IN ({', '.join(repr(w) for w in words.split())}))) AS n "
    "FROM tokens" for lang, words in fixed.STOP_WORDS.items())

ORACLES = {
    "page_head": f"SELECT page_id, regexp_extract(html, '<html lang=\"([a-z]+)', 1) AS language, "
                 f"{_UNESCAPED.format('''trim(regexp_extract(html, '<title>(.*?)</title>', 1))''')} AS page_title, "
                 "CAST(NULL AS VARCHAR) AS page_description, CAST(NULL AS VARCHAR) AS page_keywords FROM pages",
    "meta_map": f"WITH {SHOP_SQL} SELECT k AS page_id, 'description' AS name, about AS content FROM shop "
                "UNION ALL SELECT k, 'generator', 'WordPress 6.' || (k % 9) FROM shop",
    "page_links": f"WITH {_BARE}, links AS (SELECT page_id, regexp_extract_all(body, '<a href=\"([^\"]*)\"', 1) AS l FROM bare) "
                  "SELECT page_id, unnest(l) AS href, CAST(unnest(range(len(l))) AS INTEGER) AS pos FROM links",
    "script_sources": f"WITH {SHOP_SQL} SELECT k AS page_id, '/js/jquery-3.' || (k % 8) || '.1.min.js' AS src FROM shop",
    "page_elements": f"WITH {_BARE}, {_TAGS} SELECT page_id, tag, count(*) AS elements FROM tags GROUP BY ALL",
    "page_tokens": f"WITH {_BARE}, {_TAGS} SELECT page_id, tag, count(*) AS elements FROM tags GROUP BY ALL",
    "followed_links": f"""WITH {_BARE}, links AS (
        SELECT url, unnest(regexp_extract_all(body, '<a href="([^"]*)"', 1)) AS href FROM bare),
      targets AS (SELECT split_part(url, '/', 3) AS domain, url, replace(regexp_replace(
        regexp_extract(url, '^https?://[^/]+') || href, '(\\?.+)|(#.+)', '', 'g'), ' ', '') AS link FROM links)
      SELECT DISTINCT domain, url, link FROM targets WHERE NOT ("""
      + " OR ".join(f"ends_with(link, '{s}')" for s in fixed.FILE_SUFFIXES) + ")",
    "language_scripts": "SELECT doc_id, CASE doc_id % " + str(len(_ALPHABETS)) + " " + " ".join(
        f"WHEN {i} THEN {repr(lang) if lang else 'NULL'}" for i, (lang, _) in enumerate(_ALPHABETS)) + " END AS lang FROM documents WHERE regexp_matches(text, '[a-z]')",
    "strip_html": "SELECT page_id, md5(regexp_replace(html, '<.*?>', '', 'g')) AS digest, "
                  "CAST(length(regexp_replace(html, '<.*?>', '', 'g')) AS BIGINT) AS chars FROM pages",
    "clean_text": f"""WITH b AS (SELECT page_id, regexp_extract_all(html, '{_BLOCK}') AS blocks FROM pages),
      u AS (SELECT page_id, unnest(range(len(blocks))) AS pos, unnest(blocks) AS block FROM b)
      SELECT page_id, CAST(pos AS INTEGER) AS pos, """
                  + _UNESCAPED.format("regexp_replace(trim(regexp_replace(block, '<.*?>', '', 'g')), ' +', ' ', 'g')") + " AS text FROM u",
    "html_unescape": f"SELECT page_id, md5({_UNESCAPED.format('html')}) AS digest FROM pages",
    "clean_price": """
WITH d AS (SELECT p_partkey, CAST(CAST(p_retailprice AS DECIMAL(12,2)) AS DOUBLE) AS v FROM part)
SELECT p_partkey, 'dot' AS form, v AS price FROM d
UNION ALL SELECT p_partkey, 'comma', v FROM d
UNION ALL SELECT p_partkey, 'thousand dot', round(v + 1000, 2) FROM d
UNION ALL SELECT p_partkey, 'thousand comma', round(v + 1000, 2) FROM d
UNION ALL SELECT p_partkey, 'million', round(v + 2001000, 2) FROM d
UNION ALL SELECT p_partkey, 'sign', v FROM d
UNION ALL SELECT p_partkey, 'spaced', round(v + 10000, 2) FROM d
UNION ALL SELECT p_partkey, 'abbreviation', NULL FROM d""",
    "parse_headers": f"""WITH {SHOP_SQL}, lines AS (
        SELECT k, CASE WHEN k % 2 = 0 THEN 'nginx/1.' || (k % 10) || '.0' ELSE 'Apache' END AS server FROM shop)
      SELECT k AS page_id, CASE WHEN k % 11 = 0 THEN 404 ELSE 200 END AS status, server,
             CASE WHEN k % 5 = 0 THEN 'sid=' || k || '|theme: dark' END AS cookies,
             'server: ' || server || (CASE WHEN k % 5 = 0 THEN chr(10) || 'set-cookie: sid=' || k || chr(10) ||
             'set-cookie: theme: dark' ELSE '' END) || chr(10) || 'content-type: text/html; charset=utf-8' AS rendered
      FROM lines""",
    "answered_pages": f"WITH {SHOP_SQL} SELECT domain, count(*) AS answered FROM shop WHERE k % 11 <> 0 GROUP BY domain",
    "language_quality": "SELECT count(*) AS documents, TRUE AS accurate FROM documents",
    "classifier_quality": "SELECT count(DISTINCT doc_id) AS documents, TRUE AS named, TRUE AS sound, TRUE AS accurate FROM documents",
    "declared_charset": "SELECT page_id, lower(regexp_extract(html, '<meta charset=\"([^\"]+)\"', 1)) AS charset, "
                        "TRUE AS same FROM pages",
    "language_id": f"""
WITH tokens AS (SELECT doc_id, regexp_extract_all(lower(text), '\\p{{L}}+') AS words FROM documents),
counts AS ({_COUNTS}),
best AS (SELECT doc_id, lang, n FROM counts QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, lang) = 1),
found AS (SELECT doc_id, CASE WHEN n > 0 THEN lang ELSE 'en' END AS detected FROM best)
SELECT doc_id, detected, detected <> 'en' AS translatable, CASE WHEN detected <> 'en' THEN CAST(length(text) AS BIGINT) END AS chars FROM found JOIN documents USING (doc_id)""",
}
