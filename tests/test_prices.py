import random
import re
import time

import pytest
from pyspark.sql import functions as F

from pageprism import fixed
from pageprism.functions.price import html_currency, html_price
from tests import plain_patterns

NAMES = ["PRICE_PATTERNS", "CURRENCY_PATTERNS"]
FILLERS = [" ", "\n", ":", "=", '"', "'", ">", "<", "_", "-", "?", "!", ".", ",", "1", "12", "01", "02", "9,99", "$", "€", "円",
           "eur", "a", "é", "{", "\u00a0", "<span>", "span"]


def words(plain):
    """Literal texts of a pattern."""
    if "initialize" in plain:
        return ["pricetotal:", " ", "initialize(", "5.1", ")"]
    return [w for w in re.split(r"\[[^\]]*\][*+]?|\(\\s\*?\)\*?|\(01\|02\)\*|\\.|[()*+]", plain) if w and w != "|"]


@pytest.mark.parametrize("name", NAMES)
def test_linear_patterns_match_what_the_plain_ones_match(name):
    rng = random.Random(11)
    pairs = list(zip(getattr(plain_patterns, name), getattr(fixed, name), strict=True))
    for (plain, group), (needed, linear) in pairs:
        old, new, matches = re.compile(plain), re.compile(linear), 0
        for _ in range(8000):
            parts = words(plain)
            fill = [*rng.sample(FILLERS, 3), " ", ":"]
            line = [x for w in parts for x in ([w] * rng.choice([1, 1, 1, 2]) + [
                rng.choice(fill) for _ in range(rng.choice([0, 0, 1, 1, 2]))])]
            text = rng.choice(["", " ", "x", "<"]) + "".join(line) + rng.choice(["", "12.5", "7", "usd", " !"])
            found, expected = new.search(text), old.search(text)
            assert bool(found) == bool(expected), (plain, text)
            if expected:
                matches += 1
                assert (found.group(1) or "") == (expected.group(group) or ""), (plain, text)
                assert needed in text
        assert matches > 5, (plain, matches)


@pytest.mark.parametrize("run", [" ", "=", "<", "'", "_", "a", ":", "price", "price ", " price:", " pricecol span ", "formattedvalue ",
                                 "01", "1.", "<span>", "currency ", ". "])
def test_long_runs_take_linear_time(spark, run):
    text = run * (100_000 // len(run)) + "price" + run * (100_000 // len(run)) + "!"
    df = spark.createDataFrame([(text,), (text + " price: 12.50 currency: eur",)], ["page"]).coalesce(1)
    start = time.perf_counter()
    df.select(html_price("page").alias("p"), html_currency("page").alias("c")).collect()
    assert time.perf_counter() - start < 10


def test_values_behind_long_runs(spark):
    blanks = " " * 100_000
    df = spark.createDataFrame([(f"{blanks}price{blanks}:{blanks}12.50 currency{blanks}:{blanks}eur",)], ["page"])
    assert df.select(html_price("page"), html_currency("page")).first() == (12.5, "eur")
