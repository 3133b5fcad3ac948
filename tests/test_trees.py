"""Element trees made by JVM expressions: implied end tags, attributes, texts, selectors, microdata."""

import json
import random
from html.parser import HTMLParser

import pytest
from pyspark.sql import functions as F

from pageprism.functions import tree as t
from pageprism.operators import selectors
from pageprism.operators.elements import microdata_items, page_elements
from pageprism.operators.rules import load_rules
from pageprism.operators.technology import with_tree
from pageprism.sources.rule_files import texts


def rows(spark, page):
    df = spark.createDataFrame([(1, page)], "page_id long, html string")
    return sorted(page_elements(df).collect(), key=lambda r: r.pos)


def shape(spark, page):
    return [(r.tag, r.parent, r.last) for r in rows(spark, page)]


@pytest.mark.parametrize("page, want", [
    ("<p>a<p>b", [("p", -1, 0), ("p", -1, 1)]),
    ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>", [("ul", -1, 5), ("li", 0, 1), ("li", 0, 4), ("ul", 2, 4), ("li", 3, 4), ("li", 0, 5)]),
    ("<table><tr><td>a<td>b<tr><th>c<table><tr><td>in</table></table>x",
     [("table", -1, 8), ("tr", 0, 3), ("td", 1, 2), ("td", 1, 3), ("tr", 0, 8), ("th", 4, 8), ("table", 5, 8), ("tr", 6, 8), ("td", 7, 8)]),
    ("<dl><dt>a<dd>b<dt>c</dl>", [("dl", -1, 3), ("dt", 0, 1), ("dd", 0, 2), ("dt", 0, 3)]),
    ("<select><option>a<option>b</select><p>", [("select", -1, 2), ("option", 0, 1), ("option", 0, 2), ("p", -1, 3)]),
    ("<p>a<div>b</div>c", [("p", -1, 0), ("div", -1, 1)]),
    ("<div><p>a</div><b>c", [("div", -1, 1), ("p", 0, 1), ("b", -1, 2)]),
    ("<td><p>a</td></b>", [("td", -1, 1), ("p", 0, 1)]),
    ("<a href=x>1<a href=y>2</a>", [("a", -1, 0), ("a", -1, 1)]),
    ("<html><head><title>x</title><body><p>y", [("html", -1, 4), ("head", 0, 2), ("title", 1, 2), ("body", 0, 4), ("p", 3, 4)]),
    ("<div/><p>", [("div", -1, 0), ("p", -1, 1)]),
    ("<br></br><hr>", [("br", -1, 0), ("hr", -1, 1)]),
    ("x < y <3 <", []), ("", []), ("<!doctype html><!-- <p> --><?php <b> ?>", []),
    ("<script>if (a<b) '<p>'</script><p>", [("script", -1, 0), ("p", -1, 1)]), ("<div class='a", []), ("<b>x</i", [("b", -1, 0)])])
def test_shapes(spark, page, want):
    assert shape(spark, page) == want


def test_null_page(spark):
    assert rows(spark, None) == []


def test_attributes_and_texts(spark):
    page = ("<DIV ID=a Class='x  y' data-q=\"1>2 &amp; &lt;&copy;\" hidden id=b>one &amp; <b title=t/u>two</b> three<script>a && '&amp;'</script>"
            "<textarea>&lt;b></textarea></DIV>")
    found = rows(spark, page)
    assert found[0].attrs == {"id": "a", "class": "x  y", "data-q": "1>2 & <©", "hidden": ""}
    assert found[1].attrs == {"title": "t/u"}
    assert [r.text for r in found] == ["one &  three", "two", "a && '&amp;'", "<b>"]


def test_inner_text_is_in_document_order(spark):
    df = spark.createDataFrame([("<p>1<b>2<i>3</i>4</b>5<u></u>6</p><p>7",)], "html string").withColumn("tree", t.tree("html"))
    text = t.inner_text_sql("e", "tree")
    assert df.selectExpr(f"transform(tree, e -> {text}) AS x").first().x == ["123456", "234", "3", "", "7"]


class Plain(HTMLParser):
    """Nesting of a page in which every tag is closed, by the standard parser."""

    def __init__(self):
        super().__init__()
        self.found, self.open = [], []

    def handle_starttag(self, tag, attrs):
        self.found.append([tag, self.open[-1] if self.open else -1, len(self.found), dict(attrs)])
        if tag in t.VOID:
            return
        self.open.append(len(self.found) - 1)

    def handle_endtag(self, tag):
        self.found[self.open.pop()][2] = len(self.found) - 1


def test_large_closed_page_equals_the_standard_parser(spark):
    rng = random.Random(4)
    parts, open_ = [], []
    for _ in range(3000):
        if open_ and (rng.random() < 0.45 or len(open_) > 40):
            parts.append(f"</{open_.pop()}>")
        elif rng.random() < 0.1:
            parts.append("<br>")
        else:
            tag = rng.choice(["div", "span", "section", "b", "em"])
            open_.append(tag)
            parts.append(f"<{tag} n={len(parts)}>text &amp; ")
    page = "".join(parts) + "".join(f"</{x}>" for x in reversed(open_))
    plain = Plain()
    plain.feed(page)
    found = rows(spark, page)
    assert [(r.tag, r.parent, r.last, r.attrs) for r in found] == [tuple(x) for x in plain.found]
    assert len(found) > t.BLOCK * 3


def test_depth_is_bounded(spark):
    found = rows(spark, "<b>" * 2000 + "x")
    assert len(found) == 2000
    depth = {}
    for r in found:
        depth[r.pos] = 0 if r.parent < 0 else depth[r.parent] + 1
    assert max(depth.values()) == t.MOST_OPEN - 1


@pytest.mark.parametrize("selector, want", [
    ("h1 + p", [1, 3]), ("h1 ~ p", [1, 3]), ("p:not(.x)", [1]), ("p:not([class], #z)", [1]), ("div > :not(p)", [2, 4]), ("h1 ~ div > *:not(b)", []),
    ("h1+p~p.x", [3]), ("div p , h1", [0])])
def test_selectors(spark, selector, want):
    page = "<h1>a</h1><p>b</p><h1 id=q></h1><p class=x>c</p><h2></h2><div></div>" if "div" not in selector or selector.startswith("h1") else "<h1></h1><div><p></p></div><div><b></b><p class=x></p><i></i></div>"
    want_at = want if page.startswith("<h1>a") else {"div > :not(p)": [4, 6], "div p , h1": [0, 2, 5]}[selector]
    df = spark.createDataFrame([(page,)], "html string").withColumn("tree", t.tree("html"))
    hits = set()
    for s in selectors.parse(selector):
        hits |= set(df.selectExpr(f"transform(filter(tree, e -> {selectors.on_element(s, 'e', 'tree')}), e -> e.pos) AS x").first().x)
    assert sorted(hits) == want_at


@pytest.mark.parametrize("bad", ["a >", "p:hover", "a:not(b c)", "> a b +", ""])
def test_unreadable_selectors(bad):
    if bad:
        with pytest.raises(ValueError):
            selectors.parse(bad)
    else:
        assert selectors.parse(bad) == []


def items(spark, page):
    df = spark.createDataFrame([(page,)], "html string").select(microdata_items("html").alias("m"))
    return [json.loads(x) for x in df.first().m]


def test_microdata(spark):
    assert items(spark, "<div itemscope><p itemprop=name>Foo<p itemprop=description>Bar</div>") == [{"name": "Foo", "description": "Bar"}]
    page = ("<div itemscope itemtype='http://schema.org/Product'><h1 itemprop='name'>A <b>b</b>\n c</h1><img itemprop=image src=/i.png>"
            "<a itemprop='url sameAs' href=/u>x</a><meta itemprop=sku content=7><span itemprop=size content=''>L</span>"
            "<div itemprop=offers itemscope itemtype=https://schema.org/Offer><span itemprop=price>1</span>"
            "<div itemprop=seller itemscope><i itemprop=name>S \"q\"</i></div></div>"
            "<div itemprop=offers itemscope><span itemprop=price>2</span></div></div><p itemprop=loose>x<section itemscope itemprop=odd><b itemprop=k>v")
    assert items(spark, page) == [
        {"@type": "Product", "@context": "http://schema.org", "name": "A b c", "image": "/i.png", "url": "/u", "sameAs": "/u", "sku": "7", "size": "",
         "offers": [{"@type": "Offer", "@context": "https://schema.org", "price": "1", "seller": {"name": 'S "q"'}}, {"price": "2"}]}, {"k": "v"}]
    assert items(spark, "<p>no data</p>") == [] and items(spark, "") == [] and items(spark, None) == []


def test_no_python_in_the_plan(spark):
    plan = page_elements(spark.createDataFrame([(1, "<p>")], "page_id long, html string"))._jdf.queryExecution().executedPlan().toString()
    assert not any(node in plan for node in ("EvalPython", "InArrow", "InPandas"))


def test_trees_only_where_all_steps_of_a_selector_occur(spark):
    rules = load_rules(texts(spark, {"a.json": '{"A": {"dom": "nav > a[href^=\'/x\']"}, "B": {"dom": {"footer": {"text": "x"}}}}'}))
    pages = spark.createDataFrame([(1, "<p><a href='/x'>y</a></p>"), (2, "<NAV><A href='/x'>y</A></NAV>"), (3, "<nav><a>y</a></nav>"), (4, "<footer>x</footer>"), (5, None)],
                                  "page_id long, html string")
    made = with_tree(pages, rules).select("page_id", F.col("tree").isNotNull().alias("t"))
    assert {r.page_id for r in made.collect() if r.t} == {2, 4}


def test_blocks_of_any_width_give_one_tree(spark):
    texts_ = ["<ul>" + "<li>a<b>c</b>" * n + "</ul>" for n in (0, 1, 7, 8, 40, 300)]
    pages = spark.createDataFrame(list(enumerate(texts_)), "page_id long, html string")
    rows = page_elements(pages).collect()
    for k, n in enumerate((0, 1, 7, 8, 40, 300)):
        own = sorted((r.pos, r.parent, r.last, r.tag, r.text) for r in rows if r.page_id == k)
        assert own == [(0, -1, 2 * n, "ul", "")] + [e for i in range(n) for e in ((2 * i + 1, 0, 2 * i + 2, "li", "a"), (2 * i + 2, 2 * i + 1, 2 * i + 2, "b", "c"))]
