"""Golden vectors of the row functions."""

import html
from html import entities

import pytest
from pyspark.sql import functions as F

from pageprism.functions import charset, headers, markup_text, price, social, text, urls
from pageprism.functions.markup_text import anchors, tokens


def values(spark, rows, schema, column):
    df = spark.createDataFrame(rows, schema)
    out = df.select(F.monotonically_increasing_id().alias("i"), column.alias("v")).orderBy("i").collect()
    return [r.v for r in out]


def test_clean_price(spark):
    cases = {
        "1.234,56": 1234.56, "1,234.56": 1234.56, "1.234": 1234.0, "1,000": 1000.0, "12.345.678": 12345678.0,
        "99": 99.0, "1.5": 1.5, "12,5": None, "12,50": 12.5, "1.234.567,89": 1234567.89, "1,234,567.89": 1234567.89,
        "Fr. 12": None, ".99": None, "1e5": 100000.0, "": None, "free": None, "-5.50": -5.5, "1 234 EUR": 1234.0,
        "9" * 400: float("inf"), "1" + ".111" * 5000: float("inf"),
    }
    got = values(spark, [(k,) for k in cases], "p string", price.clean_price("p"))
    assert got == list(cases.values())


def test_normalize_url(spark):
    cases = [("/a/b/", "https://d.com/a/b"), ("/a?x=1#t", "https://d.com/a"), ("/a/?x", "https://d.com/a/"),
             ("/a?", "https://d.com/a?"), ("", "https://d.com")]
    got = values(spark, [(p,) for p, _ in cases], "p string", urls.normalize_url(F.lit("d.com"), "p"))
    assert got == [w for _, w in cases]


def test_hosts(spark):
    cases = [("http://www.a.com:8080/x", "www.a.com:8080", "a.com:8080"), ("http://web.a.com/", "web.a.com", "web.a.com"),
             ("http://ww1.a.com", "ww1.a.com", "a.com"), ("http://w3.a.com", "w3.a.com", "a.com"),
             ("http://wa.com/", "wa.com", "wa.com"), ("http://wwwa.com/", "wwwa.com", "wwwa.com"),
             ("/rel", None, None), ("http://[bad/", None, None), ("http://a b|c/", "a b|c", "a b|c")]
    rows = [(u,) for u, *_ in cases]
    assert values(spark, rows, "u string", urls.authority("u")) == [a for _, a, _ in cases]
    assert values(spark, rows, "u string", urls.strip_www(urls.authority("u"))) == [b for *_, b in cases]


def test_same_site(spark):
    rows = [("https://shop.com/x",), ("https://a.shop.com/",), ("https://notshop.com/",), ("https://x.org/?u=shop.com",)]
    assert values(spark, rows, "u string", urls.same_site("u", F.lit("shop.com"))) == [True, True, False, False]
    assert values(spark, rows, "u string", urls.same_site("u", F.lit("shop.com"), "substring")) == [True] * 4


def test_paths(spark):
    rows = [("/a.PDF",), (None,), ("/a.pdf",), ("/a.pdf\n",)]
    assert values(spark, rows, "p string", urls.is_page_path("p")) == [True, True, False, True]
    rows = [("/shop/product/1",), ("/x-p-12.html",), ("/products",), ("/a.product.b",), (None,)]
    assert values(spark, rows, "p string", urls.is_product_path("p")) == [True, True, False, True, False]


def test_links(spark):
    rows = [("mailto:a@b",), ("#top",), ("/x",), ("javascript:x",)]
    assert values(spark, rows, "h string", urls.is_page_link("h")) == [False, False, True, False]
    rows = [("/a b?x=1",), ("http://q.com/z#f",)]
    assert values(spark, rows, "h string", urls.resolve_link(F.lit("http://d.com"), "h")) == [
        "http://d.com/ab", "http://q.com/z"]
    rows = [("http://d.com/x/y",), ("http://other.org/x/",)]
    assert values(spark, rows, "u string", urls.site_root("u", F.lit("d.com"))) == ["http://d.com", "http://other.org/x"]


UNESCAPES = ["a &amp; b", "&amp;lt;", "&lt;b&gt; &quot;x&quot;", "&#39;&#x27;", "&euro;&nbsp;&hellip;", "&#128;", "&#0;",
             "&copy 2020", "&notit;", "no & entity &", "&#x1F600;", "&bogus; x", "&eacute;t&eacute;", "?a=1&b=2", "&AMP;"]


def test_unescape(spark):
    rows = [(t,) for t in UNESCAPES] + [(None,)]
    want = [html.unescape(t) for t in UNESCAPES] + [None]
    assert values(spark, rows, "t string", text.unescape_html("t")) == want
    rows = [(t,) for t in ["&check; &excl; &comma;", "&NotEqualTilde; &amp;", "&CounterClockwiseContourIntegral;", "a&NewLine;b&Tab;c",
                           "&#00000000000065; &#99999999999999999999; &#x000000041; &#xFFFFFFFFFFF;", "&#1;&#xB;&#x7f;&#xFFFE;&#13;&#128;",
                           "&#38;amp; &notit; &amp;lt; &AMP &unknown; & &; &#; &#x;"]]
    assert values(spark, rows, "t string", text.unescape_html("t")) == [html.unescape(t) for (t,) in rows]
    rows = [(f"&{n}",) for n in sorted(entities.html5)]
    assert values(spark, rows, "t string", text.unescape_html("t")) == [html.unescape(t) for (t,) in rows]


def test_references_in_links(spark):
    links = {"/caf&eacute;": "/café", "&#x2F;p": "/p", "&#38;amp;": "&amp;", "/a?b=1&copy=2&lt=3": "/a?b=1&copy=2&lt=3",
             "/a?b=1&amp;c=2": "/a?b=1&c=2", "&quot;&#34;&apos;&#39;": "\"\"''", "&lt;&#62;&check;": "<>✓", "a&#32;b&Tab;": "a b\t",
             "&amp;eacute;": "&eacute;", "/x&copy": "/x©", "&#38;eacute;": "&eacute;"}
    page = "".join(f'<a href="{a}">x</a>' for a in links) + "<a href=a&#32;b&gt;c class=x>"
    df = spark.createDataFrame([(page,)], "html string").select(tokens("html").alias("t")).select(anchors("t"))
    assert df.first()[0] == [*links.values(), "a b>c"]


def test_clean_text(spark):
    rows = [(" <b>A</b>\n  B &amp; C ",), (" x ",), (None,), ("a < b",)]
    assert values(spark, rows, "t string", text.clean_text("t")) == ["A B & C", "x", None, "a < b"]


def test_product_text(spark):
    rows = [("a", "b"), ("None", "b"), ("a", None), (" null ", "UNDEFINED"), (None, None)]
    assert values(spark, rows, "t string, d string", text.product_text("t", "d")) == ["a. b", "b", "a", None, None]


def test_language_tags(spark):
    assert values(spark, [("de-AT",), ("pt_BR",), ("en",)], "t string", text.primary_language("t")) == ["de", "pt", "en"]


def test_charset(spark):
    rows = [('<meta charset="Windows-1252">',), ("<meta http-equiv=Content-Type content='text/html; charset=utf-8'>",),
            ("<p>none</p>",)]
    assert values(spark, rows, "h string", charset.declared_charset("h")) == ["windows-1252", "utf-8", "iso-8859-1"]
    data = [(bytearray("é".encode()),), (bytearray("<meta charset=latin1>é".encode("latin-1")),)]
    assert [r.t for r in charset.with_text(spark.createDataFrame(data, "b binary"), "b", "t").collect()] == ["é", "<meta charset=latin1>é"]


def test_parse_headers(spark):
    block = "HTTP/1.1 200 OK\r\nA: 1\r\na: 2\r\nB: x: y\r\nnonsense"
    got = values(spark, [(block,)], "h string", headers.parse_headers("h"))[0]
    assert got == {"status": ["HTTP/1.1 200 OK"], "a": ["1", "2"], "b": ["x: y"]}
    df = spark.createDataFrame([(block,)], "h string").withColumn("m", headers.parse_headers("h"))
    assert df.select(headers.status_code("m")).first()[0] == 200


@pytest.mark.parametrize("link, want", [
    ("https://twitter.com/foo/status/1", [("twitter", "https://twitter.com/foo")]),
    ("https://twitter.com/share?u=1", []),
    ("https://www.youtube.com/channel/UC1/videos", [("youtube", "https://www.youtube.com/channel/UC1")]),
    ("https://www.facebook.com/acme/", [("facebook", "https://www.facebook.com/acme")]),
    ("https://developers.facebook.com/acme/", []),
    ("https://www.facebook.com/share/x", []),
    ("https://www.instagram.com/shop/p1", [("instagram", "https://www.instagram.com/shop")]),
    ("https://www.tiktok.com/@x/", [("tiktok", "https://www.tiktok.com/@x")]),
    ("https://example.org/", []),
    ("https://www.instagram.com/pizzashop", [("instagram", "https://www.instagram.com/pizzashop")]),
    ("https://www.facebook.com/aboutyou", [("facebook", "https://www.facebook.com/aboutyou")]),
    ("https://twitter.com/shareasale", [("twitter", "https://twitter.com/shareasale")]),
    ("https://www.facebook.com/sharer/sharer.php?u=x", []), ("https://www.facebook.com/sharer.php?u=x", []),
    ("https://www.instagram.com/p/xyz/", []), ("https://twitter.com/home?status=x", []),
    ("https://nottwitter.com/acme", []), ("https://e.com/r?to=https://twitter.com/acme", []), ("https://e.com/play.google.com", []),
])
def test_social(spark, link, want):
    got = values(spark, [(link,)], "l string", social.social_accounts("l"))[0]
    assert [(s.platform, s.account) for s in got] == want


PAGE = """<!doctype html><HTML lang=de-AT><head><title>A &amp; <b>B</b></title>
<meta name="description" content='it&#39;s'><meta name=Keywords content=k><meta content="two" name="description">
<!-- <a href="/hidden"> --><script>var x = "<a href='/script'>";</script><script src=/s.js></script></head>
<body><a href="/one" title="a > b">1</a><a data-href="/no">x</a><a class=c href=/two?a=1&amp;b=2>2</a><A HREF=''>3</A>
<svg><title>picture</title></svg></body>"""


def test_tokens(spark):
    df = spark.createDataFrame([(PAGE,)], "html string").withColumn("t", markup_text.tokens("html"))
    row = df.select(markup_text.anchors("t").alias("a"), markup_text.script_sources("t").alias("s"),
                    markup_text.meta_map("t").alias("m"), markup_text.page_head("t").alias("h")).first()
    assert row.a == ["/one", "/two?a=1&b=2", ""]
    assert row.s == ["/s.js"]
    assert row.m == {"description": "two", "keywords": "k"}
    assert tuple(row.h) == ("de", "A & B", "it's", None)


def test_long_pages_do_not_overflow_the_matcher(spark):
    long = "<p " + " ".join(f'a{i}="{i}"' for i in range(30_000)) + ' href="/x">' + "<!--" + "x" * 300_000 + "--><a href=/y>"
    df = spark.createDataFrame([(long,)], "html string").withColumn("t", markup_text.tokens("html"))
    assert df.select(markup_text.anchors("t")).first()[0] == ["/y"]
    digits = "price: 1" + ".111" * 20_000
    df = spark.createDataFrame([(digits,)], "low string")
    assert df.select(price.html_price("low")).first()[0] == float("inf")
