import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from pageprism.llm.spelling import neighbours, op11_spelling_variants, roots, runs, stride, variant_groups, word_counts
from tests.llm.helpers import odd_docs

SF = "/root/testdata/sf0.001"


def plain_counts(rows, least_length=5, least_count=3):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
            if h % 97 == 0:
                k = h % len(word)
                word = word[:k] + word[k + 1:]
            counts[word] += 1
    return {w: n for w, n in counts.items() if len(w) >= least_length and n >= least_count}


def plain_neighbours(words):
    """By patterns with one letter left out or masked."""
    by_key = defaultdict(set)
    for w in words:
        by_key[w].add(w)
        for i in range(len(w)):
            by_key[w[:i] + w[i + 1:]].add(w)
            by_key[w[:i] + "*" + w[i + 1:]].add(w)
    near = defaultdict(set)
    for key, group in by_key.items():
        for u in group:
            for v in group:
                if u != v and ("*" in key or len(u) != len(v) and key in (u, v)):
                    near[u].add(v)
    return near


def plain_groups(counts, ratio=2):
    near, out = plain_neighbours(counts), {}
    forms = {}
    for w, n in counts.items():
        best = min(near[w], key=lambda v: (-counts[v], v), default=None)
        forms[w] = best if best is not None and counts[best] >= ratio * n else None
    for w, n in counts.items():
        root = w
        while forms[root] is not None:
            root = forms[root]
        out[w] = (forms[w], root, n, len(near[w]), None if forms[w] is None else counts[forms[w]])
    return out


def as_dict(frame):
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in frame.collect()}


def test_registered_query(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    found = op11_spelling_variants(spark, SF)
    assert found.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert as_dict(found) == plain_groups(plain_counts(rows))


def test_equals_brute_force_at_the_next_scale(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()]
    found = as_dict(op11_spelling_variants(spark, "/root/testdata/sf0.01"))
    expected = plain_groups(plain_counts(rows))
    assert len(expected) > 1000 and any(r[1] != r[0] and r[0] for r in expected.values())
    assert found == expected


@pytest.mark.parametrize("letters", ["ab", "abcé"])
def test_neighbours_of_dense_and_repetitive_words(letters, spark):
    rng = random.Random(3)
    words = {"".join(rng.choice(letters) for _ in range(rng.randrange(5, 11))) for _ in range(400)}
    words |= {"a" * n for n in range(5, 14)} | {"x" * 3000, "x" * 2999, "x" * 1500 + "y" + "x" * 1499, "x" * 3001, "y" + "x" * 2999, "x" * 2999 + "y"}
    found = neighbours(spark.createDataFrame([(w,) for w in words], "word string"))
    expected = plain_neighbours({w for w in words if len(w) < 100})
    long = [w for w in words if len(w) > 100]
    for u in long:
        for v in long:
            if u != v and one_edit(u, v):
                expected[u].add(v)
    pairs = [tuple(r) for r in found.collect()]
    assert len(pairs) == len(set(pairs))
    assert set(pairs) == {(u, v) for u, near in expected.items() for v in near}


def one_edit(u, v):
    if len(u) < len(v):
        u, v = v, u
    if len(u) - len(v) > 1:
        return False
    i = next((i for i, (x, y) in enumerate(zip(u, v)) if x != y), len(v))
    return u[i + 1:] == (v[i + 1:] if len(u) == len(v) else v[i:])


def test_runs():
    assert runs("Ab÷c×D 12 éÉ_x-y's naïve".encode()) == "ab÷c×d éÉ x y s naïve".encode().split()
    assert runs("Ab “quoted” Łódź  x".encode()) == [b"ab", b"quoted", "ód".encode(), b"x"]
    assert runs(b"") == []


def test_strides():
    assert [stride(n) for n in (1, 2, 3, 4, 7, 8, 9)] == [1, 2, 2, 4, 4, 8, 8]


def test_roots_of_long_chains(spark):
    n = 41
    chain = spark.createDataFrame([(f"w{i:02d}", f"w{i + 1:02d}") for i in range(n)], "word string, form string")
    assert {tuple(r) for r in roots(chain).collect()} == {(f"w{i:02d}", f"w{n}") for i in range(n)}


def test_counts_of_checksums_and_long_runs(spark):
    rng = random.Random(8)
    vocabulary = ["".join(rng.choice("abcdeé") for _ in range(rng.randrange(1, 9))) for _ in range(60)] + ["long" * 20, "É" * 40]
    rows = [(i, " ".join(rng.choice(vocabulary).upper() if rng.random() < 0.2 else rng.choice(vocabulary) for _ in range(80))) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert {r.word: r.n for r in word_counts(docs).collect()} == plain_counts(rows)


def test_odd_rows(spark):
    docs = odd_docs(spark)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert as_dict(variant_groups(docs)) == plain_groups(plain_counts(rows))
    assert variant_groups(docs.limit(0)).count() == 0
    assert variant_groups(docs.where("doc_id = 3")).count() == 0
