"""Rules that can't be used are reported, and the literal gate never hides a match."""

import json
import re

import pytest
from pyspark.sql import functions as F

from pageprism.operators.language import learn_profile, score_languages
from pageprism.operators import rules as rule_operators
from pageprism.operators.rules import load_rules
from pageprism.operators.technology import required_literal


def test_unreadable_selectors_are_rejected(spark):
    rules = {"A": {"dom": "a:not(.x)"}, "B": {"dom": "a + b"}, "C": {"dom": "div ~ p"}, "D": {"dom": "div.shop"}, "E": {"html": "(unclosed"}}
    loaded = load_rules(spark.createDataFrame([("r.json", json.dumps(rules))], "file string, text string"))
    assert {r.tech for r in loaded.rejected} == {"A", "B", "C", "E"}


@pytest.mark.parametrize("pattern, text", [
    (r"\x41bcd", "Abcd"), (r"Abcdef", "Abcdef"), (r"\x2fpath", "/path"), (r"\d+shopware", "12shopware"), (r"(a)bcd\1efg", "abcdaefg"),
    (r"wp\-content", "wp-content"), (r"foo\.js", "foo.js"), (r"abc\s{2}def", "abc  def"),
])
def test_literal_gate_passes_matches(pattern, text):
    assert re.search(pattern, text)
    assert required_literal(pattern) in text.lower()


def test_profile_has_no_cut_and_keeps_all_rows(spark):
    docs = spark.createDataFrame([(1, "the cat and the dog", "en"), (2, "der hund und die katze", "de")], "id int, text string, lang string")
    profile = learn_profile(docs)
    found = {r.id: r.lang_detected for r in score_languages(spark.createDataFrame([(1, "the dog"), (2, "und der"), (3, "зжш"), (4, None)], "id int, text string"), profile, "id").collect()}
    assert found == {1: "en", 2: "de", 3: None, 4: None}
    assert learn_profile(docs, size=3).count() <= 6


def test_rule_files_has_no_limit_on_rules(spark, monkeypatch):
    from pageprism.catalog.stores import rule_files

    monkeypatch.setattr(rule_operators, "MAX_RULE_ROWS", 50)
    found = rule_files(spark, "/root/testdata/sf0.001")
    assert found.count() > 50 and {r.valid for r in found.select("valid").distinct().collect()} == {True, False}


def test_null_patterns_and_selectors_are_checked(spark):
    rows = [("A", None, ""), ("B", "a+", None), ("C", "(", ""), ("D", "", "div.shop")]
    checked = rule_operators.checked_rules(spark.createDataFrame(rows, "tech string, pattern string, selector string"))
    assert {r.tech: r.valid for r in checked.collect()} == {"A": False, "B": True, "C": False, "D": True}


def test_rare_words_are_scored_like_frequent_ones(spark, monkeypatch):
    from pageprism.operators import language

    docs = spark.createDataFrame([(1, "the cat and the dog", "en"), (2, "der hund und die katze", "de"), (3, "the end", "en")], "id int, text string, lang string")
    profile = learn_profile(docs)
    texts = spark.createDataFrame([(1, "the the the dog"), (2, "und der und zzz"), (2, "katze"), (3, "cat katze"), (4, None), (None, "the")], "id int, text string")
    whole = sorted(map(str, score_languages(texts, profile, "id").collect()))
    monkeypatch.setattr(language, "FREQUENT_WORDS", 3)
    assert sorted(map(str, score_languages(texts, profile, "id").collect())) == whole
    assert "Row(id=1, lang_detected='en')" in whole and "Row(id=2, lang_detected='de')" in whole and len(whole) == 5


def test_rows_meet_words_and_not_grams(spark, tmp_path):
    docs = spark.range(40).selectExpr("CAST(id AS INT) AS id", "concat('the cat sat on the mat ', id) AS text", "'en' AS lang")
    plan = score_languages(docs, learn_profile(docs), "id")._jdf.queryExecution().optimizedPlan().toString()
    assert "gram" not in plan


def test_implied_reads_what_is_found_once(spark):
    from pageprism.operators.technology import with_implied

    found = spark.createDataFrame([("a", "T1", "1"), ("a", "T2", None), ("b", "T3", "9"), ("b", "T9", None)], "domain string, technology string, version string")
    implies = spark.createDataFrame([("T1", "T2"), ("T2", "T3"), ("T3", "T4"), ("T3", "T3")], "tech string, implied string")
    marked = found.withColumn("technology", F.upper("technology"))
    one, two = with_implied(marked, implies, ["domain"]), with_implied(marked, implies, ["domain"], hops=2)
    assert one._jdf.queryExecution().optimizedPlan().toString().count("upper(") == 1
    assert sorted(map(tuple, one.collect()), key=str) == sorted([("a", "T1", "1"), ("a", "T2", None), ("a", "T3", None), ("b", "T3", "9"), ("b", "T4", None), ("b", "T9", None)], key=str)
    assert {(r.domain, r.technology) for r in two.collect()} == {(r.domain, r.technology) for r in one.collect()} | {("a", "T4")}
