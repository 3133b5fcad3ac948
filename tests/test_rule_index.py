"""Rules by the index of their texts against rules as literals."""

import pytest
from pyspark.sql import functions as F

from pageprism.operators import rule_index as x
from pageprism.operators.rules import load_rules
from pageprism.operators.technology import html_hits
from pageprism.sources.rule_files import texts

RULES = r'''{"A": {"html": "data-mage-init\\;version:\\1", "url": "/shop/(\\d+)\\;version:v\\1"}, "B": {"html": ["colou?r", "wp-content/(.+?)\\.js\\;version:\\1?x\\1:none"]},
"C": {"html": "(broken"}, "D": {"html": "a|bcd"}, "E": {"html": "Track\\((\\d+)\\);\\;version:\\1\\;confidence:60"}, "F": {"url": "\\.php$"}, "G": {"html": "é+ta"},
"H": {"html": "[(]x(?:y)(?<n>z)\\;version:\\1"}, "I": {"html": ""}, "J": {"html": "abcd"}}'''
PAGES = [(1, "https://d/shop/12", "<p DATA-MAGE-INIT>color"), (2, "https://d/x.php", "wp-content/abc.js TRACK(7);"), (3, "u", "bcd (xyz"), (4, "u", None),
         (5, None, "ABCD éta"), (6, "", ""), (7, "https://d/shop/", "wp-content/.js colour abc")]


def test_equals_literals(spark):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    files = texts(spark, {"a.json": RULES})
    found = {tuple(r) for r in x.matches(pages, x.rules_of_files(files)).collect()}
    hits = pages.withColumn("lowered", F.lower("html")).withColumn("h", F.explode(html_hits(load_rules(files), lowered="lowered")))
    want = {tuple(r) for r in hits.select("page_id", "h.technology", "h.version", "h.confidence", "h.field").collect()}
    assert found == want and len(want) > 10


def test_invalid_rules(spark):
    rules = spark.createDataFrame([("A", "html", "(x"), ("B", "html", "x")], "tech string, field string, pattern string")
    assert [r.tech for r in x.invalid(rules).collect()] == ["A"]


@pytest.mark.parametrize("pattern, want", [("a(b)(?:c)(?<d>e)(?=f)(?<!g)", 2), (r"\(a[(]b\)", 0), ("[]()](x)", 1), ("[^](](x)", 1), ("", 0)])
def test_groups(spark, pattern, want):
    assert spark.createDataFrame([(pattern,)], "p string").select(x._groups("p")).first()[0] == want


def test_grams(spark):
    df = spark.createDataFrame([("abcdefgabcd\nxyz",), ("abc",), ("",)], "t string")
    for r in df.select("t", F.expr(x.grams("t")).alias("g")).collect():
        assert sorted(r.g) == sorted({r.t[i:i + 4] for i in range(len(r.t) - 3)})


def test_empty_rules_and_pages(spark):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    rules = x.rules_of_files(texts(spark, {"a.json": RULES}))
    assert x.matches(pages.limit(0), rules).count() == 0
    assert x.matches(pages, rules.limit(0)).count() == 0


def test_inner_words_are_the_index(spark):
    rules = x.rules_of_files(texts(spark, {"a.json": '{"A": {"html": "/p/12/next"}, "B": {"html": "/p/13/nexty"}, "C": {"html": "jquery"}, "D": {"html": "-12-12"}}'}))
    index = {(r.tech, r.field, r.gram) for r in x.rarest_grams(rules).join(rules.select("rule", "tech"), "rule").collect()}
    assert ("B", "html#", "13") in index
    assert {f for t, f, _ in index if t in "ABD"} == {"html#"} and {f for t, f, _ in index if t == "C"} == {"html"}
    pages = spark.createDataFrame([(1, "", "x/P/12/NEXT"), (2, "", "/p/112/next /p/13/nextyz"), (3, "", "xjqueryx"), (4, "", "a-12-12b"), (5, "", "/p/12/nex 13")],
                                  "page_id long, url string, html string")
    found = sorted((r.page_id, r.technology) for r in x.matches(pages, rules).collect())
    assert found == [(1, "A"), (2, "B"), (3, "C"), (4, "D")]
