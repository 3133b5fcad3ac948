"""Registered queries over element trees, on pages that leave out end tags, quotes and more."""

from __future__ import annotations

from pyspark.sql import functions as F

from pageprism.catalog.frames import table
from pageprism.functions.tree import inner_text_sql, tree
from pageprism.operators import markup, selectors
from pageprism.operators.elements import page_elements
from pageprism.operators.rows import spread, unnest

SELECTORS = {
    "siblings": "li ~ li", "adjacent": "td + td", "negated": "ul > li:not(.b)", "descendant": "table tr td", "child": "div > i, div > b",
    "attribute": "td[colspan]:not([colspan='1'])", "several": "p + p, li + li.b",
}


def _messy(spark, sf_dir):
    """One page per part, in seven shapes: paragraphs, lists and tables without end tags, no page, an empty page, odd attributes with a cut-off
    tag, and microdata in paragraphs without end tags."""
    part = spread(table(spark, sf_dir, "part"))
    name, brand, kind, key, size = (F.col(c).cast("string") for c in ("p_name", "p_brand", "p_type", "p_partkey", "p_size"))
    lit = F.lit
    shapes = [
        F.concat(lit("<p itemprop=name>"), name, lit("<p itemprop=description>"), kind),
        F.concat(lit("<ul><li>"), name, lit('<li class="b">'), brand, lit("<ul><li>in</ul></ul>")),
        F.concat(lit("<table><tr><td>"), name, lit("<td>"), brand, lit("<tr><td colspan=2>"), kind, lit("</table>")),
        lit(None).cast("string"),
        lit(""),
        F.concat(lit("<!-- <b> --><div ID=a"), key, lit(" class='x y' data-v=\""), size, lit('" hidden><b>'), name, lit("<i>x</i>"), brand,
                 lit("</b>tail<br/>&amp;</span></div><p>cut <a hre")),
        F.concat(lit('<div itemscope itemtype="http://schema.org/Product"><p itemprop=name>'), name, lit("<p itemprop=description>"), kind,
                 lit('<div itemprop=offers itemscope itemtype=http://schema.org/Offer><meta itemprop=priceCurrency content=EUR><span itemprop=price>'),
                 size, lit("</span></div></div>")),
    ]
    html = F.element_at(F.array(*shapes), (F.col("p_partkey") % 7).cast("int") + 1)
    return part.select(F.col("p_partkey").alias("page_id"), html.alias("html"))


def element_tree(spark, sf_dir):
    """All elements with their place in the tree, attributes and own text."""
    attrs = F.array_join(F.transform(F.array_sort(F.map_entries("attrs")), lambda e: F.concat(e["key"], F.lit("="), e["value"])), "|")
    return page_elements(_messy(spark, sf_dir)).select("page_id", "pos", "parent", "last", "tag", attrs.alias("attrs"), "text")


def page_trees(spark, sf_dir):
    """Given pages: per page the elements, the roots, and the greatest number of elements inside one."""
    found = page_elements(spread(table(spark, sf_dir, "pages")))
    return found.groupBy("page_id").agg(
        F.count(F.lit(1)).alias("elements"), F.count_if(F.col("tag") == "html").alias("roots"),
        F.max(F.when(F.col("tag") == "html", F.col("last") - F.col("pos"))).cast("long").alias("inside_html"))


def select_elements(spark, sf_dir):
    """Elements that fit selectors with siblings, children, descendants and negation, with their whole text."""
    trees = _messy(spark, sf_dir).select("page_id", tree("html").alias("tree"))
    hits = [F.expr(f"transform(filter(tree, e -> {' OR '.join(f'({selectors.on_element(s, 'e', 'tree')})' for s in selectors.parse(text))}), "
                   f"e -> named_struct('selector', '{name}', 'pos', e.pos, 'text', {inner_text_sql('e', 'tree')}))")
            for name, text in SELECTORS.items()]
    return unnest(trees, ["page_id"], F.concat(*hits), "h").select("page_id", "h.selector", "h.pos", "h.text")


def microdata_tree(spark, sf_dir):
    """Product fields of microdata whose paragraphs have no end tags."""
    pages = _messy(spark, sf_dir).withColumn("tokens", F.array().cast("array<string>"))
    items = markup.markup_items(markup.markup_columns(pages)).where("syntax = 'microdata'")
    return items.select("page_id", "seq", F.expr(markup.product_fields("item")).alias("f")).select(
        "page_id", "seq", "f.product_title", "f.product_description", "f.price", "f.currency")


QUERIES = {f.__name__: f for f in (element_tree, page_trees, select_elements, microdata_tree)}

#: Elements of each shape: pos, parent, last, tag, attributes, own text (SQL over ``part``).
_ROWS = {
    0: [(0, -1, 0, "p", "'itemprop=name'", "p_name"), (1, -1, 1, "p", "'itemprop=description'", "p_type")],
    1: [(0, -1, 4, "ul", "''", "''"), (1, 0, 1, "li", "''", "p_name"), (2, 0, 4, "li", "'class=b'", "p_brand"), (3, 2, 4, "ul", "''", "''"),
        (4, 3, 4, "li", "''", "'in'")],
    2: [(0, -1, 5, "table", "''", "''"), (1, 0, 3, "tr", "''", "''"), (2, 1, 2, "td", "''", "p_name"), (3, 1, 3, "td", "''", "p_brand"),
        (4, 0, 5, "tr", "''", "''"), (5, 4, 5, "td", "'colspan=2'", "p_type")],
    5: [(0, -1, 3, "div", "'class=x y|data-v=' || p_size || '|hidden=|id=a' || p_partkey", "'tail&'"), (1, 0, 2, "b", "''", "p_name || p_brand"),
        (2, 1, 2, "i", "''", "'x'"), (3, 0, 3, "br", "''", "''"), (4, -1, 4, "p", "''", "'cut '")],
    6: [(0, -1, 5, "div", "'itemscope=|itemtype=http://schema.org/Product'", "''"), (1, 0, 1, "p", "'itemprop=name'", "p_name"),
        (2, 0, 2, "p", "'itemprop=description'", "p_type"), (3, 0, 5, "div", "'itemprop=offers|itemscope=|itemtype=http://schema.org/Offer'", "''"),
        (4, 3, 4, "meta", "'content=EUR|itemprop=priceCurrency'", "''"), (5, 3, 5, "span", "'itemprop=price'", "CAST(p_size AS VARCHAR)")],
}
#: Elements of each shape that a selector finds: pos, whole text.
_HITS = {
    "siblings": [(1, 2, "p_brand || 'in'")], "adjacent": [(2, 3, "p_brand")], "negated": [(1, 1, "p_name"), (1, 4, "'in'")],
    "descendant": [(2, 2, "p_name"), (2, 3, "p_brand"), (2, 5, "p_type")], "child": [(5, 1, "p_name || 'x' || p_brand")],
    "attribute": [(2, 5, "p_type")], "several": [(0, 1, "p_type"), (1, 2, "p_brand || 'in'"), (6, 2, "p_type")],
}

_PAGE_TAGS = "regexp_replace(html, '(?s)<!--.*?-->|<script>.*?</script>|<style>.*?</style>', '', 'g')"
ORACLES = {
    "element_tree": " UNION ALL ".join(
        f"SELECT p_partkey AS page_id, {pos} AS pos, {parent} AS parent, {last} AS last, '{tag}' AS tag, {attrs} AS attrs, {text} AS text "
        f"FROM part WHERE p_partkey % 7 = {shape}" for shape, rows in _ROWS.items() for pos, parent, last, tag, attrs, text in rows),
    "page_trees": f"""WITH c AS (SELECT page_id, len(regexp_extract_all({_PAGE_TAGS}, '<[a-zA-Z][a-zA-Z0-9]*[^>]*>'))
          + len(regexp_extract_all(html, '<(script|style)>')) AS n FROM pages)
      SELECT page_id, CAST(n AS BIGINT) AS elements, CAST(1 AS BIGINT) AS roots, CAST(n - 1 AS BIGINT) AS inside_html FROM c""",
    "select_elements": " UNION ALL ".join(
        f"SELECT p_partkey AS page_id, '{name}' AS selector, {pos} AS pos, {text} AS text FROM part WHERE p_partkey % 7 = {shape}"
        for name, rows in _HITS.items() for shape, pos, text in rows),
    "microdata_tree": "SELECT p_partkey AS page_id, 0 AS seq, p_name AS product_title, p_type AS product_description, "
                      "CAST(p_size AS DOUBLE) AS price, 'EUR' AS currency FROM part WHERE p_partkey % 7 = 6",
}
