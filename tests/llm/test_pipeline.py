"""Pipeline stages against what was planted in a small fixture."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from pageprism.llm import packing
from tests.llm.helpers import odd_docs
from tests.llm.test_simhash import near, plain_groups, plain_print

SF = "/root/testdata/sf0.01"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def planted(spark):
    """Clean documents, exact and near copies (one word in a hundred changed), secrets, and texts in no known language."""
    rng = random.Random(8)
    clean = [r for r in spark.read.parquet(f"{SF}/documents.parquet").where("length(text) between 1200 and 4000").orderBy("doc_id").collect()]
    rows, seen = [], []

    def shingles(t):
        w = t.lower().split()
        return {tuple(w[i:i + 5]) for i in range(len(w) - 4)}
    for r in clean:
        own = shingles(r.text)
        if all(len(own & o) < 0.4 * len(own | o) for o in seen):
            rows.append((r.doc_id, r.text, r.lang, r.source, r.n_chars))
            seen.append(own)
        if len(rows) == 150:
            break
    near = []
    for i, (_, text, lang, source, _) in enumerate(rows[:40]):
        words = text.split(" ")
        for k in rng.sample(range(len(words)), max(1, len(words) // 100)):
            words[k] = f"changed{k}"
        near.append((10_000 + i, " ".join(words), lang, source, 0))
    exact = [(20_000 + i, *r[1:]) for i, r in enumerate(rows[40:80])]
    secret = [(30_000, rows[100][1] + " password=abcdef99 tail", "en", "src0", 0)]
    foreign = [(40_000 + i, "жшщ юяэ ъыь цчг " * 60, None, "src0", 0) for i in range(3)] + [(40_010, None, "en", "src0", 0)]
    docs = spark.createDataFrame(rows + near + exact + secret + foreign, "doc_id long, text string, lang string, source string, n_chars long")
    return docs, rows


def test_languages(spark, planted):
    docs, rows = planted
    out = pipeline.identify_languages(spark, docs, SF)
    ids = {r.doc_id for r in out.collect()}
    assert out.columns == COLUMNS and not [i for i in ids if 40_000 <= i < 50_000] and {r[0] for r in rows} <= ids


def test_near_duplicates(spark, planted):
    docs, rows = planted
    out = pipeline.drop_near_duplicates(spark, docs.where("text is not null"), SF)
    ids = Counter(r.doc_id for r in out.collect())
    assert out.columns == COLUMNS and max(ids.values()) == 1
    assert {r[0] for r in rows} <= set(ids)                       # clean documents stay
    assert not [i for i in ids if 20_000 <= i < 30_000]           # exact copies go
    kept = docs.where("text is not null").select("doc_id", "text").collect()
    prints = {r.doc_id: plain_print(r.text) for r in kept}
    groups = plain_groups(near(set(prints.values())), set(prints.values()))
    assert set(ids) == {min(k for k in prints if groups[prints[k]] == g) for g in set(groups.values())}


def test_rows_of_one_doc_id_are_documents_of_their_own(spark, planted):
    _, rows = planted
    docs = spark.createDataFrame([(1, *rows[0][1:]), (1, *rows[1][1:]), (1, *rows[0][1:])], "doc_id long, text string, lang string, source string, n_chars long")
    assert sorted(r.text for r in pipeline.drop_near_duplicates(spark, docs, SF).collect()) == sorted((rows[0][1], rows[1][1]))


def test_secrets(spark, planted):
    docs, rows = planted
    out = {r.doc_id: r for r in pipeline.redact_secrets(spark, docs, SF).collect()}
    assert len(out) == docs.count() and "[SECRET] tail" in out[30_000].text and "abcdef99" not in out[30_000].text
    assert sum(out[r[0]].text == r[1] for r in rows) >= 0.9 * len(rows)


def test_mixing_keeps_all(spark, planted):
    docs, _ = planted
    skewed = docs.withColumn("source", F.when(F.col("doc_id") % 3 > 0, "big").otherwise(F.col("source")))
    out = pipeline.mix_sources(spark, skewed, SF)
    times = Counter(r.doc_id for r in out.collect())
    assert out.columns == COLUMNS and set(times) == {r.doc_id for r in docs.collect()} and max(times.values()) > 1


def test_odd_rows_pass_every_stage(spark):
    docs = odd_docs(spark)
    for name, stage in pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns, name
        out.collect()
        assert stage(spark, docs.limit(0), SF).count() == 0, name
    assert pipeline.pack_sequences(spark, docs, SF).count() >= docs.count()


def test_run(spark):
    pieces = pipeline.run(spark, "/root/testdata/sf0.001").collect()
    by = Counter()
    for r in pieces:
        by[r.sequence_id] += r.length
        assert len(r.ids) == 4 * r.length
    assert max(by.values()) <= packing.SEQUENCE_TOKENS
    docs = {r.doc_id for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    assert {r.doc_id for r in pieces} <= docs and len({r.doc_id for r in pieces}) > 0.5 * len(docs)
