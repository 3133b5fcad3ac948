"""SimHash groups against brute force."""

import numpy as np
import xxhash
from pyspark.sql import functions as F

from pageprism.llm import simhash
from pageprism.llm.components import components
from tests.llm.helpers import odd_docs


def plain_print(text, n=3):
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").translate(
        {i: " " for i in range(9, 14)}).split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i:i + n]) for i in range(max(1, len(words) - n + 1))]
    votes = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), 42)
        for k in range(64):
            votes[k] += h >> k & 1
    return sum(1 << k for k in range(64) if 2 * votes[k] > len(shingles))


def plain_groups(pairs_of, items):
    up = {x: x for x in items}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x
    for a, b in pairs_of:
        a, b = sorted((top(a), top(b)))
        up[b] = a
    return {x: top(x) for x in items}


def near(prints, r=2):
    p = sorted(prints)
    a = np.array(p, np.uint64)
    return [(p[i], p[j]) for i in range(len(p)) for j in np.nonzero(np.bitwise_count(a ^ a[i]) <= r)[0] if i < j]


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def test_links_on_dense_and_sparse_prints(spark):
    rng = np.random.default_rng(3)
    base = [int(x) for x in rng.integers(0, 2**63, 300)]
    dense = {base[0] ^ (1 << int(a)) ^ (1 << int(b)) ^ (1 << int(c)) for a, b, c in rng.integers(0, 64, (400, 3))}
    some = {x ^ (1 << int(a)) ^ (1 << int(b)) for x in base[:150] for a, b in rng.integers(0, 64, (2, 2))}
    prints = {*base, *dense, *some, 0, 3, (1 << 64) - 1, (1 << 63) - 1}
    df = spark.createDataFrame([(signed(x),) for x in prints], "fp long")
    want = plain_groups([(signed(a), signed(b)) for a, b in near(prints)], [signed(x) for x in prints])
    for long_posting in (4, 64, 10_000):
        found = {r.node: r.component for r in components(simhash.links(df, 2, long_posting)).collect()}
        assert {x: found.get(x, x) for x in want} == {x: min(y for y in want if want[y] == want[x]) for x in want}


def test_components_of_chains(spark):
    edges = [(i, i + 1) for i in range(500)] + [(1000, i) for i in range(1001, 1400)] + [(5000, 5000), (None, 3)]
    found = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(found[i] == 0 for i in range(501)) and all(found[i] == 1000 for i in range(1000, 1400)) and found[5000] == 5000
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_query_against_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    rows = {r.doc_id: r for r in simhash.op4_simhash(spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    prints = {d.doc_id: plain_print(d.text) for d in docs}
    assert {k: r.fingerprint for k, r in rows.items()} == {k: f"{v:016x}" for k, v in prints.items()}
    groups = plain_groups(near(set(prints.values())), set(prints.values()))
    want = {k: min(j for j in prints if groups[prints[j]] == groups[prints[k]]) for k in prints}
    assert {k: r.component_id for k, r in rows.items()} == want and len(rows) == len(docs)


def test_odd_rows(spark):
    docs = odd_docs(spark)
    rows = simhash.near_duplicates(docs).collect()
    assert len(rows) == docs.count()
    by = {r.doc_id: r for r in rows}
    assert by[2].component_id == by[3].component_id == by[4].component_id == 2 and by[2].fp == 0
    assert by[7].component_id == 1 and by[5].component_id == 5 and by[None].component_id is None
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


def test_spark_agrees_on_hashes(spark):
    h = spark.range(1).select(F.xxhash64(F.lit("a b c"))).first()[0]
    assert int(simhash.shingle_hashes(b"A b\tc", 3)[0]) == h % (1 << 64)


def test_one_of_each_group_stays(spark):
    words = [f"w{i}" for i in range(3000)]
    rows = [(3, " ".join(words), "a"), (2, " ".join(words[:-1] + ["other"]), "b"), (2, "another text of the same doc_id", "c"),
            (None, " ".join(words), "d"), (None, "a text without doc_id", "e"), (None, "a text without doc_id", "f"), (7, None, "g"), (8, "", "h"),
            (9, "twice the same row", "i"), (9, "twice the same row", "i")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
    prints = {r.fp for r in simhash.near_duplicates(docs.where("doc_id in (2, 3) and length(text) > 100")).collect()}
    assert len(prints) > 0 and np.bitwise_count(np.array([p & (2**64 - 1) for p in prints], np.uint64)[:1] ^ np.array([p & (2**64 - 1) for p in prints], np.uint64)[-1:])[0] <= 2
    out = simhash.drop_near_duplicates(docs)
    found = sorted(((r.doc_id, (r.text or "")[:6]) for r in out.collect()), key=str)
    assert out.columns == docs.columns
    assert found == sorted([(2, "w0 w1 "), (2, "anothe"), (None, "a text"), (7, ""), (9, "twice ")], key=str)
    again = sorted(map(tuple, simhash.drop_near_duplicates(docs.repartition(2)).collect()), key=str)
    assert again == sorted(map(tuple, out.collect()), key=str)
    assert simhash.drop_near_duplicates(docs.limit(0)).count() == 0
    odd = odd_docs(spark)
    assert simhash.drop_near_duplicates(odd).columns == odd.columns
