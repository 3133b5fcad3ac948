"""Operators against brute force, properties and plans."""

import hashlib
import json
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from pageprism.operators import budget, dedupe, index, markup, selectors, technology as tech
from pageprism.operators.elements import page_elements
from pageprism.operators.domains import registered_domain
from pageprism.operators.frontier import frontier
from pageprism.operators.links import live_only, social_links
from pageprism.operators.products import with_tokens
from pageprism.operators.ranking import rank_by_hash, salted_join, shuffle_key
from pageprism.operators.rules import load_rules
from pageprism.sources.rule_files import sample_rules, texts


def order(path):
    return hashlib.md5(f"0|{path}".encode()).hexdigest()


def pages(n=900):
    """One domain holds a third of all pages."""
    return [("big" if i % 3 == 0 else f"d{i % 20}", f"/{i}", i % 7 == 0) for i in range(n)]


def budget_by_loop(rows, limits):
    kept = defaultdict(list)
    live = {}
    groups = defaultdict(list)
    for domain, path, product in rows:
        groups[domain].append((order(path), path, product))
    for domain, records in groups.items():
        records.sort()
        at = products = 0
        stop = booster = False
        while at <= len(records) and at <= limits.max_pages and products <= limits.max_products and not stop:
            batch = records[at:at + limits.batch_size]
            for _, path, product in batch:
                at += 1
                products += product
                kept[domain].append(path)
            if at >= limits.max_products and products == 0:
                stop = True
            if at >= limits.relevance_check and products * 100 / at < limits.relevance_threshold:
                stop = True
            if not batch:
                stop = booster = True
        live[domain] = booster and products <= limits.max_products
    return {(d, p) for d, ps in kept.items() for p in ps}, {d for d, b in live.items() if b}


@pytest.mark.parametrize("limits", [
    budget.Limits(), budget.Limits(5, 40, 10, 20, 15.0), budget.Limits(10, 100, 1000, 1000, 2.0),
    budget.Limits(7, 60, 3, 14, 50.0)])
def test_page_budget_equals_the_loop(spark, limits):
    rows = pages()
    df = spark.createDataFrame(rows, "domain string, url_path string, is_product boolean")
    got = budget.page_budget(df, limits=limits).collect()
    kept, live = budget_by_loop(rows, limits)
    assert {(r.domain, r.url_path) for r in got} == kept
    assert {r.domain for r in got if r.needs_live} == live


def test_needs_live_includes_domains_without_records(spark):
    rows = spark.createDataFrame(pages(), "domain string, url_path string, is_product boolean")
    seeds = spark.createDataFrame([("big",), ("none",)], "domain string")
    assert {r.domain for r in budget.needs_live(seeds, budget.page_budget(rows)).collect()} == {"big", "none"}


def test_wider_caps_keep_more_pages(spark):
    df = spark.createDataFrame(pages(), "domain string, url_path string, is_product boolean")
    small = {r.url_path for r in budget.page_budget(df, limits=budget.Limits(5, 20, 5, 900, 0.0)).collect()}
    large = {r.url_path for r in budget.page_budget(df, limits=budget.Limits(5, 60, 9, 900, 0.0)).collect()}
    assert small < large


@pytest.mark.parametrize("limit", [None, 4])
def test_rank_by_hash(spark, limit):
    rows = [(d, p) for d, p, _ in pages()]
    df = spark.createDataFrame(rows, "domain string, url_path string").withColumn("o", shuffle_key("url_path"))
    got = {(r.domain, r.url_path): (r.rn, r.total) for r in rank_by_hash(df, ["domain"], "o", ["url_path"], limit).collect()}
    want, groups = {}, defaultdict(list)
    for d, p in rows:
        groups[d].append(p)
    for d, ps in groups.items():
        for i, p in enumerate(sorted(ps, key=order), 1):
            if limit is None or i <= limit:
                want[(d, p)] = (i, len(ps))
    assert got == want


def test_salted_join_keeps_every_row(spark):
    left = spark.createDataFrame([(d, p) for d, p, _ in pages()], "domain string, url_path string")
    side = spark.createDataFrame([("big", 1), ("d1", 2)], "domain string, v int")
    plain = left.join(side, "domain", "left").orderBy("url_path").collect()
    assert salted_join(left, side, ["domain"]).orderBy("url_path").collect() == plain
    assert salted_join(left, side, ["domain"], "left_semi").count() == left.join(side, "domain", "left_semi").count()


def test_keep_latest_is_idempotent(spark):
    old = spark.createDataFrame([("a", "u1", "2024-01-01", 1), ("a", "u2", "2024-03-01", 2)], "domain string, url string, last_update string, v int")
    new = spark.createDataFrame([("a", "u1", "2024-01-01", 9), ("a", "u2", "2024-02-01", 8), ("a", "u1", "2024-01-01", 9)], old.schema)
    merged = dedupe.keep_latest(new, old, ["domain", "url"])
    rows = sorted(merged.collect())
    assert [tuple(r) for r in rows] == [("a", "u1", "2024-01-01", 9), ("a", "u2", "2024-03-01", 2)]
    assert sorted(dedupe.keep_latest(new, merged, ["domain", "url"]).collect()) == rows


def test_index_upsert_is_idempotent(spark):
    rows = [("d", "c", f"/{i}", "f", i, 1) for i in range(5)]
    df = spark.createDataFrame(rows + rows, "domain string, crawl string, url_path string, warc_filename string, warc_record_offset long, warc_record_length long")
    once = index.merge_index(df, df)
    assert once.count() == 5 and index.merge_index(once, df).count() == 5


def test_crawls_for_year():
    assert index.crawls_for_year("2025") == ["CC-MAIN-2025-05"]
    assert index.crawls_for_year(1999) == index.crawls_for_year()


def test_live_only(spark):
    live = spark.createDataFrame([("d", "https://d/a"), ("d", "https://d/b")], "domain string, link string")
    archive = spark.createDataFrame([("d", "https://d/a")], "domain string, url string")
    assert [r.link for r in live_only(live, archive).collect()] == ["https://d/b"]


def test_social_keeps_the_first_platform(spark):
    links = spark.createDataFrame([("d", 1, "https://twitter.com/a/x"), ("d", 0, "https://twitter.com/a/")], "domain string, pos int, href string")
    assert [tuple(r) for r in social_links(links).collect()] == [("d", "twitter", "https://twitter.com/a")]


def merged(spark, html):
    df = with_tokens(spark.createDataFrame([(html,)], "html string"))
    return markup.merge_markup(markup.markup_columns(df)).select(*markup.FIELDS).first()


def test_merge_takes_the_longest_then_the_earliest(spark):
    html = """<meta property="og:type" content="product"><meta property="og:title" content="ab">
      <script type="application/ld+json">{"@type": "Product", "name": "abc"}</script>
      <div itemscope itemtype="https://schema.org/Product"><i itemprop="name">xyz</i></div>"""
    assert merged(spark, html).product_title == "xyz"


@pytest.mark.parametrize("item, want", [
    ('{"@type": "Product", "offers": {"price": 1234.5, "priceCurrency": "EUR"}}', (1234.5, "EUR")),
    ('{"@type": "Product", "offers": {"price": 12.500, "priceCurrency": "EUR"}}', (12.5, "EUR")),
    ('{"@type": "Product", "offers": {"price": "7"}, "price": "5"}', (5.0, None)),
    ('{"@type": "Product", "offers": {"price": "7"}}', (7.0, None)),
    ('{"@type": "Product", "offers": [{"price": 20000000, "priceCurrency": "USD"}]}', (20000000.0, "USD")),
    ('{"@type": "Product", "offers": [[{"price": 3, "priceCurrency": "USD"}]]}', (3.0, "USD")),
    ('{"@type": "Product", "price": "9,99", "priceCurrency": "CHF"}', (9.99, "CHF")),
    ('{"@type": ["Thing", "Product"], "offers": {"price": "1.234,00", "priceCurrency": "EUR"}}', (1234.0, "EUR")),
    ('{"@type": "WebPage", "price": "9"}', (None, None)),
])
def test_markup_price(spark, item, want):
    row = merged(spark, f'<script type="application/ld+json">{item}</script>')
    assert (row.price, row.currency) == want


@pytest.mark.parametrize("item, want", [
    ('{"@type": "Product", "brand": {"name": "A &amp; B"}}', "A & B"),
    ('{"@type": "Product", "brand": {"id": 1}}', None),
    ('{"@type": "Product", "object": {"brand": {"name": "N"}}}', "N"),
    ('{"@type": "Product", "brand": ["x"], "offers": {"brand": "O"}}', "O"),
])
def test_markup_brand(spark, item, want):
    assert merged(spark, f'<script type="application/ld+json">{item}</script>').brand == want


def test_variants_and_graphs(spark):
    group = '{"@type":"ProductGroup","name":"g","hasVariant":{"@type":"Product","name":"v"}}'
    assert merged(spark, f'<script type="application/ld+json">{group}</script>').product_title == "v"
    graph = '{"@graph":[{"@type":"WebSite","name":"s"},{"@type":"Product","name":"p"}]}'
    assert merged(spark, f'<script type="application/ld+json">{graph}</script>').product_title == "p"


TREE = '<div class="x nav"><p>t1 <a href="/u" class=l>Upptime</a></p><br><p>two<span>in</span></div><footer id=f>end'


def test_elements(spark):
    df = spark.createDataFrame([(1, TREE), (2, None)], "page_id long, html string")
    rows = sorted(page_elements(df).collect(), key=lambda r: r.pos)
    assert [(r.tag, r.parent, r.last) for r in rows] == [
        ("div", -1, 5), ("p", 0, 2), ("a", 1, 2), ("br", 0, 3), ("p", 0, 5), ("span", 4, 5), ("footer", -1, 6)]
    assert rows[2].attrs == {"href": "/u", "class": "l"}


@pytest.mark.parametrize("selector, want", [
    ("p > a[href*='/u']", 1), ("div a", 1), ("div > a", 0), ("div.nav", 1), (".x.nav, #f", 2), ("a[href^='/u'][class]", 1),
    ("*[id=f]", 1), ("div p span", 1), ("a[class~=l]", 1), ("footer#f", 1), ("a[href$='v']", 0)])
def test_selectors(spark, selector, want):
    df = with_tokens(spark.createDataFrame([(TREE,)], "html string"))
    from pageprism.operators.elements import element_array

    df = df.withColumn("tree", element_array("html", F.lit(True)))
    total = 0
    for s in selectors.parse(selector):
        total += df.selectExpr(f"size(filter(tree, e -> {selectors.on_element(s, 'e', 'tree')})) AS n").first().n
        if s.simple:
            n = df.selectExpr(f"size(filter(tokens, t -> {selectors.on_token(s.steps[0], 't')})) AS n").first().n
            assert n == df.selectExpr(f"size(filter(tree, e -> {selectors.on_element(s, 'e', 'tree')})) AS n").first().n
    assert total == want


@pytest.mark.parametrize("pattern, want", [
    ("data-mage-init", "data-mage-init"), (r"track\((\d+)\);", ""), ("a|bcd", ""), ("colou?r-scheme", "r-scheme"),
    (r"wp-content/.+\.js", "wp-content/"), ("(?:abc)?def", ""), ("x{2,3}abcd", "abcd"), ("[abc]defg", "defg")])
def test_required_literal(pattern, want):
    got = tech.required_literal(pattern)
    assert got == want or (want == "" and got in ("track(", "track", "def", ""))


def test_rule_files(spark):
    tag = "\\;"
    old = {"T": {"cats": [1], "html": "old"}, "U": {"meta": "gen", "implies": [f"T{tag}confidence:50"], "cats": [2, 1, 9]}}
    new = {"T": {"cats": [1], "html": ["one", f"two{tag}version:\\1{tag}confidence:7"], "headers": {"X-A": ""},
                 "dom": {"a": {"text": "", "attributes": {"Href": "z"}}}}}
    kinds = {"1": {"name": "one"}, "2": {"name": "two", "groups": [3], "priority": 4}}
    rules = load_rules(texts(spark, {"a.json": json.dumps(old), "b.json": json.dumps(new)}),
                       texts(spark, {"c.json": json.dumps(kinds)}))
    rows = {(r.tech, r.field, r.key, r.selector, r.pattern, r.version_tpl, r.confidence) for r, _ in rules.rows}
    assert rows == {
        ("T", "html", "", "", "one", None, 100), ("T", "html", "", "", "two", "\\1", 7),
        ("T", "headers", "x-a", "", "", None, 100), ("T", "dom", "", "a", "", None, 100),
        ("T", "dom", "href", "a", "z", None, 100), ("U", "meta", "generator", "", "gen", None, 100)}
    assert [tuple(r) for r in rules.implies.collect()] == [("U", "T")]
    found = spark.createDataFrame([("d", "U", None), ("d", "Z", "1")], "domain string, technology string, version string")
    full = tech.with_categories(tech.with_implied(found, rules.implies, ["domain"]), rules.tech_categories)
    assert {(r.technology, tuple(r.categories)) for r in full.collect()} == {("U", ("two", "one")), ("T", ("one",)), ("Z", ())}


def test_broken_patterns_are_reported(spark):
    assert [r.tech for r in sample_rules(spark).rejected] == ["Broken rule"]


def test_version_templates(spark):
    df = spark.createDataFrame([("x-2.5",), ("x-",)], "t string")
    sql = tech.version("t", r"x-([\d.]+)?", r"\1?v\1:none", 1)
    assert [r.v for r in df.selectExpr(f"{sql} AS v").collect()] == ["v2.5", "none"]


def test_implied_hops(spark):
    implies = spark.createDataFrame([("A", "B"), ("B", "C"), ("C", "A")], "tech string, implied string")
    found = spark.createDataFrame([("d", "A", "1")], "domain string, technology string, version string")
    one = {r.technology for r in tech.with_implied(found, implies, ["domain"]).collect()}
    all_ = {(r.technology, r.version) for r in tech.with_implied(found, implies, ["domain"], hops=5).collect()}
    assert one == {"A", "B"} and all_ == {("A", "1"), ("B", None), ("C", None)}


def test_frontier_respects_the_cap(spark):
    edges = [("d", str(i), str(j)) for i in range(40) for j in (2 * i + 1, 2 * i + 2)]
    links = spark.createDataFrame(edges, "domain string, source string, target string")
    roots = spark.createDataFrame([("d", "0"), ("lonely", "9")], "domain string, page string")
    rows = frontier(links, roots, cap=20).collect()
    mine = sorted((r.position, r.depth, r.page) for r in rows if r.domain == "d")
    assert [p for p, *_ in mine] == list(range(1, 21))
    assert [d for _, d, _ in mine] == [0] + [1] * 2 + [2] * 4 + [3] * 8 + [4] * 5
    assert sum(r.domain == "lonely" for r in rows) == 1


def test_native_operators_stay_in_the_jvm(spark):
    from pageprism.catalog import indexes, markups, texts as text_queries

    sf = "/root/testdata/sf0.001"
    for query in (indexes.QUERIES["index_dedupe"], indexes.QUERIES["page_budget"], text_queries.QUERIES["page_head"],
                  markups.QUERIES["social_links"], markups.QUERIES["html_price"]):
        plan = query(spark, sf)._jdf.queryExecution().optimizedPlan().toString()
        assert "Python" not in plan and "InPandas" not in plan


def test_filters_reach_the_scan(spark, tmp_path):
    df = spark.createDataFrame([("d", "CC-MAIN-2024-10", "warc", "/a", "f", 0, 1), ("e", "CC-MAIN-2024-18", "robotstxt", "/b", "f", 1, 1)],
                               "url_host_registered_domain string, crawl string, subset string, url_path string, warc_filename string, "
                               "warc_record_offset long, warc_record_length long")
    df.write.partitionBy("crawl", "subset").parquet(str(tmp_path / "index"))
    from pageprism.sources.tables import read_crawl_index

    hits = index.select_index(read_crawl_index(spark, str(tmp_path / "index")), ["CC-MAIN-2024-10"])
    assert [r.domain for r in index.lookup(hits, ["d"], ["CC-MAIN-2024-10"]).collect()] == ["d"]
    plan = index.lookup(hits, ["d"], ["CC-MAIN-2024-10"])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(crawl" in plan or "PartitionFilters: [isnotnull(subset" in plan
    assert "PushedFilters: [IsNotNull(url_host_registered_domain), EqualTo(url_host_registered_domain,d)]" in plan


def test_registered_domains_follow_the_rules_of_the_list(spark):
    rules = spark.createDataFrame([(r,) for r in ("com", "uk", "co.uk", "*.ck", "!www.ck", "a.b.c.d.e", None)], "suffix string")
    want = {"www.shop.com": "shop.com", "a.b.co.uk": "b.co.uk", "co.uk": None, "x.y.ck": "x.y.ck", "y.ck": None, "z.www.ck": "www.ck",
            "p.q.a.b.c.d.e": "q.a.b.c.d.e", "www.x.ru": "x.ru", "com": None, "1.2.3.4": None, None: None}
    df = spark.createDataFrame([(h,) for h in want], "host string")
    got = {r.host: r.d for r in registered_domain(df, "host", "d", rules).collect()}
    assert got == want
    short = spark.createDataFrame([("www.x.ru",), ("a.shop.com.sg",), ("x.y.co.kr",)], "host string")
    assert {r.d for r in registered_domain(short, "host", "d").collect()} == {"x.ru", "shop.com.sg", "y.co.kr"}


def test_rows_without_a_key_are_ranked_too(spark):
    df = spark.createDataFrame([(None, "/a"), (None, "/b"), ("d", "/c")], "domain string, url_path string")
    assert sorted((r.domain or "", r.rn, r.total) for r in budget.shuffled(df).collect()) == [("", 1, 2), ("", 2, 2), ("d", 1, 1)]


def test_frontier_goes_on_to_the_last_page(spark):
    links = spark.createDataFrame([("d", str(i), str(i + 1)) for i in range(12)] + [("d", "5", "0"), ("e", "0", "1"), (None, "0", "x"), ("d", "0", None)],
                                  "domain string, source string, target string")
    roots = spark.createDataFrame([("d", "0"), ("f", None)], "domain string, page string")
    assert {(r.page, r.depth, r.position) for r in frontier(links, roots).collect()} == {(str(i), i, i + 1) for i in range(13)}
    assert frontier(links, roots.limit(0)).count() == 0


def test_a_round_reads_the_folders_of_its_front(spark, monkeypatch):
    from pageprism.operators import frontier as module

    read = []
    real = module._read
    monkeypatch.setattr(module, "_read", lambda s, tables, wanted: read.append(sum(len(t.folders(wanted)) for t in tables)) or real(s, tables, wanted))
    chains = [(d, str(i), str(i + 1)) for d in "abcdefgh" for i in range(40 if d == "a" else 3)]
    links = spark.createDataFrame(chains, "domain string, source string, target string")
    roots = spark.createDataFrame([(d, "0") for d in "abcdefgh"], "domain string, page string")
    assert frontier(links, roots).count() == 41 + 7 * 4
    late = read[4 * 10:-1]
    assert max(late) <= 5  # of hundreds: a front, its bucket of links, of candidates and of known pages


def test_frontier_of_many_rounds_reads_few_folders(spark, monkeypatch):
    from pageprism.operators import frontier as module

    read = []
    monkeypatch.setattr(module, "_read_rounds", lambda spark, rounds, f=module._read_rounds: read.append(len(rounds)) or f(spark, rounds))
    chain = spark.range(11).selectExpr("'a' AS domain", "CAST(id AS STRING) AS source", "CAST(id + 1 AS STRING) AS target")
    found = module.frontier(chain, spark.createDataFrame([("a", "0")], "domain string, page string"))
    assert sorted((r.depth, r.page) for r in found.collect()) == [(i, str(i)) for i in range(12)]
    assert max(read) <= module.MERGED


def test_only_scripts_that_a_text_has_are_counted(spark):
    from pageprism.operators.language import detect_language, script_language

    assert "THEN named_struct('n', length(" in script_language("x") and "array(named_struct('n'" not in script_language("x")
    texts = ["αβγ abc αβγδ", "это слово", "їжак", "ハロー世界", "世界世界", "سلام پ", "क का कि", "ᎠᎡᎢ", "123 ½ £", "éa abc Ω", "", None]
    rows = spark.createDataFrame(list(enumerate(texts)), "id int, text string").select("id", detect_language("text").alias("lang")).collect()
    assert [r.lang for r in sorted(rows)] == ["el", "ru", "uk", "ja", "zh", "fa", "hi", None, "en", "en", "en", None]
