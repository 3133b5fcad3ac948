"""Mixing, line rules and Hilbert shards: SQL twins, brute force, and no Python in the plans."""

import zlib
from collections import Counter, defaultdict
from itertools import product

import pytest
from pyspark.sql import functions as F

from pageprism.llm import hilbert, line_rules, mixing, queries
from tests.llm.helpers import odd_docs
from tests.oracle import compare, connect

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_sql_twin(spark, name):
    assert compare(queries.QUERIES[name](spark, SF), connect(SF), queries.ORACLES[name]) is None


@pytest.mark.parametrize("name", ["op1_mixing", "op5_line_rules", "op9_hilbert_shards"])
def test_no_python_in_plans(spark, name):
    plan = queries.QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert not any(w in plan for w in ("Python", "Pandas", "Arrow"))


# mixing

def test_weights_meet_the_limits(spark):
    docs = spark.createDataFrame([(i, "w " * 10, "big" if i < 600 else f"s{i % 7}") for i in range(1000)], "doc_id long, text string, source string")
    rows = mixing.mix(docs, repetitions=1.5, block_tokens=500).collect()
    by, tokens = Counter(r.source for r in rows), 10
    first = Counter(r.source for r in rows if r.epoch == 0)
    assert first == Counter("big" if i < 600 else f"s{i % 7}" for i in range(1000))
    times = {s: by[s] / first[s] for s in by}
    assert times["big"] == 1 and max(times.values()) <= 1.5 + 1 / 50
    blocks = defaultdict(list)
    for r in rows:
        blocks[r.block].append(r)
    for own in blocks.values():
        assert sorted(r.position for r in own) == list(range(1, len(own) + 1))
        assert abs(sum(r.tokens for r in own) - 500) <= 8 * tokens
    mixed = mixing.mix(docs, repetitions=1e9, budget_tokens=3000).collect()
    assert abs(sum(r.tokens for r in mixed) - 3000) <= 8 * tokens


def test_exponent_is_the_least_that_holds(spark):
    shares = spark.createDataFrame([(0.7,), (0.2,), (0.06,), (0.04,)], "share double")
    import math

    def entropy(e):
        p = [x ** e for x in (0.7, 0.2, 0.06, 0.04)]
        return -sum(x / sum(p) * math.log(x / sum(p)) for x in p) / math.log(4)
    e = mixing.find_exponent(shares, 0.8, 1e9)
    assert entropy(e) <= 0.8 < entropy(e - 1e-6)
    e = mixing.find_exponent(shares, 1.0, 3.0)
    assert (0.04 / 0.7) ** (e - 1) <= 3 < (0.04 / 0.7) ** (e - 1 - 1e-6)


def test_mixing_odd_rows(spark):
    docs = odd_docs(spark)
    rows = mixing.mix(docs).collect()
    assert {r.doc_id for r in rows if r.epoch == 0} == {1, 2, 3, 4, 5, None, 7, 8, 9, -3} and min(r.tokens for r in rows) == 1
    assert Counter(r.doc_id for r in rows if r.epoch == 0)[5] == 2
    assert mixing.mix(docs.limit(0)).count() == 0


# line rules

def test_repeated_words_against_brute_force(spark):
    import random

    rng = random.Random(4)
    texts = [" ".join(rng.choice("abcd") for _ in range(rng.randrange(0, 40))) for _ in range(300)] + ["a a a a", "x y z\n x  y z", None, "", " \n "]
    found = line_rules.base_rules(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()

    def plain(t):
        w = (t or "").split()
        n = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
        return len({i + k for i in range(len(w) - 2) if n[tuple(w[i:i + 3])] > 1 for k in range(3)})
    assert {r.doc_id: r.n_repeat_words for r in found} == {i: plain(t) for i, t in enumerate(texts)}


def test_lines_in_excess_deplete(spark):
    own = lambda i, n: " ".join(f"own{i}x{j}" for j in range(n))
    shared = " ".join(f"shared{j}" for j in range(60))
    rows = [(i, f"{shared}\n{own(i, 20)}", "a") for i in range(6)] + [(10, f"{shared.upper()} \n{own(10, 100)}", "a"), (11, f"{shared}\n{own(11, 20)}", "b"),
            (12, f"{shared}\n{own(12, 20)}", None)] + [(20 + i, own(20, 80), "c") for i in range(9)] + [(40, None, "a"), (41, "short", "a")]
    found = {r.doc_id: r for r in line_rules.judge(spark.createDataFrame(rows, "doc_id long, text string, source string"), line_documents=6).collect()}
    assert len(found) == len(rows)
    assert [found[i].kept for i in range(6)] == [False] * 6 and found[10].kept and found[11].kept and found[12].kept
    assert found[0].removed_words == 60 and found[11].removed_words == 0
    assert all(found[20 + i].kept for i in range(9))
    assert not found[40].kept and found[40].base_failed and not found[41].kept


def test_line_rules_odd_rows(spark):
    docs = odd_docs(spark)
    rows = line_rules.judge(docs).collect()
    assert len(rows) == docs.count()
    assert {r.n_words for r in rows if r.doc_id in (2, 3, 4)} == {0} and line_rules.judge(docs.limit(0)).count() == 0
    long = [r for r in rows if r.doc_id == 5]
    assert len(long) == 2 and all(r.n_repeat_words == r.n_words == 27_000 and r.base_failed for r in long)


# Hilbert shards

@pytest.mark.parametrize("n,bits", [(2, 3), (3, 2), (4, 1), (3, 3)])
def test_curve_visits_neighbours(spark, n, bits):
    points = spark.createDataFrame(list(product(range(1 << bits), repeat=n)), ", ".join(f"x{i} int" for i in range(n)))
    rows = points.withColumn("at", hilbert.curve_index([F.col(f"x{i}") for i in range(n)], bits)).collect()
    path = [tuple(r[:n]) for r in sorted(rows, key=lambda r: r.at)]
    assert [r.at for r in sorted(rows, key=lambda r: r.at)] == list(range(1 << bits * n))
    assert all(sum(abs(a - b) for a, b in zip(p, q)) == 1 for p, q in zip(path, path[1:]))


def check_shards(rows, docs, shards=24):
    want = Counter((d.doc_id, len((d.text or "").encode()) + 8, zlib.crc32((d.text or "").encode())) for d in docs)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == want
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    sizes = [len(slots.get(i, [])) for i in range(shards)]
    assert sum(sizes) == len(docs) and max(sizes) - min(sizes) <= 1 and set(slots) <= set(range(shards))


def test_shards_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    rows = hilbert.op9_hilbert_shards(spark, SF).collect()
    check_shards(rows, docs)
    assert {(r.law, r.grown_shard) for r in rows} == {("rows", None)}
    runs = sorted(((r.shard, r.curve) for r in hilbert.shard(spark.read.parquet(f"{SF}/documents.parquet")).collect()))
    assert [c for _, c in runs] == sorted(c for _, c in runs)


def test_shards_odd_rows(spark):
    docs = odd_docs(spark)
    check_shards(hilbert.shard(docs).collect(), docs.select("doc_id", "text").collect())
    check_shards(hilbert.shard(docs, 3).collect(), docs.select("doc_id", "text").collect(), 3)
    assert hilbert.shard(docs.limit(0)).count() == 0


def test_texts_are_stored_in_the_order_of_blocks(spark, tmp_path):
    docs = spark.createDataFrame([(i, f"w{i} " * 10, "hot" if i < 900 else f"s{i % 3}", i) for i in range(1000)], "doc_id long, text string, source string, extra long")
    mixing.mixed_texts(docs, block_tokens=1000).write.parquet(str(tmp_path / "mixed"))
    rows = spark.read.parquet(str(tmp_path / "mixed")).withColumns(
        {"file": F.input_file_name(), "at": F.monotonically_increasing_id()}).orderBy("file", "at").collect()
    place = {}
    for r in mixing.mix(docs, block_tokens=1000).collect():
        place.setdefault(r.block, {})[r.position] = r.doc_id
    want = [place[b][p] for b in sorted(place) for p in sorted(place[b])]
    assert [r.doc_id for r in rows] == want and all(r.extra == r.doc_id for r in rows)
    whole = Counter(r.source for r in rows)["hot"] / len(rows)
    for i in range(0, len(rows) - 100, 100):
        assert abs(sum(r.source == "hot" for r in rows[i:i + 100]) / 100 - whole) < 0.1
    assert sum(a.doc_id == b.doc_id for a, b in zip(rows, rows[1:])) < 0.05 * len(rows)
