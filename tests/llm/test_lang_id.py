"""Language identification: held-out accuracy, rejection and odd rows."""

import zlib

import numpy as np

from pageprism.llm import lang_id
from tests.llm.helpers import LONG, odd_docs

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    rows = {r.doc_id: r for r in lang_id.op6_language(spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    assert len(rows) == len(docs)
    held = [d for d in docs if zlib.crc32(str(d.doc_id).encode()) % 5 == 0]
    assert {d.doc_id for d in held} == {k for k, r in rows.items() if r.held_out}
    right = [rows[d.doc_id].lang_pred == d.lang for d in held]
    assert np.mean(right) >= 0.97
    assert all(0 <= r.score <= 1 for r in rows.values())
    assert np.mean([rows[d.doc_id].rejected for d in docs]) <= 0.01


def test_only_learned_rows_count(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(200)
    model = lang_id.train(docs)
    from pyspark.sql import functions as F

    changed = docs.withColumn("lang", F.when(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit("xx")).otherwise(F.col("lang")))
    other = lang_id.train(changed)
    assert model.languages == other.languages and np.allclose(model.vectors, other.vectors)


def test_odd_rows_and_rejection(spark):
    docs = odd_docs(spark)
    model = lang_id.train(spark.read.parquet(f"{SF}/documents.parquet"))
    rows = lang_id.identify(docs, model).collect()
    assert len(rows) == docs.count() and rows[0].start == 7
    by = {r.doc_id: r for r in rows}
    assert all(by[k].lang_pred == "und" and by[k].score == 0 and by[k].rejected for k in (2, 3, 4))
    assert model.predict("жшщ юяэ ъыь " * 30)[2] and model.predict("的 是 不 了 人 我 在 有 他 " * 20)[2]
    assert lang_id.identify(docs.limit(0), model).count() == 0
    none = lang_id.train(docs.limit(0))
    assert none.predict("abc") == ("und", 0.0, True)


def test_counts_do_not_depend_on_pieces():
    old = lang_id._PIECE
    try:
        whole = lang_id.gram_counts(LONG)
        lang_id._PIECE = 100
        assert np.array_equal(lang_id.gram_counts(LONG), whole)
    finally:
        lang_id._PIECE = old


def plain_prediction(text, model):
    """Cosine with every centroid, from n-grams counted one by one."""
    letters = [c if c.isalpha() else " " for c in text.lower()]
    words = "".join(letters).split()
    if not words:
        return "und", 0.0
    row = " " + " ".join(words) + " "
    vector = np.zeros(lang_id.FEATURES)

    def place(h):
        return ((h ^ (h >> 15)) & 0x7FFFFFFF) % lang_id.FEATURES

    def wrapped(h):
        return (h + (1 << 63)) % (1 << 64) - (1 << 63)
    for i in range(len(row) - 1):
        two = wrapped(ord(row[i]) * 0x9E3779B1 + ord(row[i + 1]) * 0x85EBCA6B)
        vector[place(two)] += 1
        if i + 2 < len(row) and row[i + 1] != " ":
            vector[place(wrapped(wrapped(two * 31) + ord(row[i + 2]) * 0xC2B2AE35))] += 1
    weighted = np.log1p(vector) * model.idf
    cosines = model.vectors @ (weighted / np.linalg.norm(weighted))
    best = int(cosines.argmax())
    return model.languages[model.owner[best]], float(cosines[best])


def test_predictions_equal_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    model = lang_id.train(docs)
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in lang_id.identify(docs, model).collect():
        lang, score = plain_prediction(texts[r.doc_id], model)
        assert r.lang_pred == lang and abs(r.score - max(0.0, min(1.0, score))) < 1e-4


def test_sparse_rows_equal_dense_ones():
    rng = np.random.default_rng(0)
    dense = np.where(rng.random((30, lang_id.FEATURES)) < 0.01, rng.random((30, lang_id.FEATURES)), 0).astype(np.float32)
    start = np.concatenate([[0], np.cumsum((dense > 0).sum(1))])
    rows = lang_id.Rows(start, np.nonzero(dense)[1], dense[dense > 0])
    centres = rng.random((3, lang_id.FEATURES)).astype(np.float32)
    assert np.allclose(rows.cosines(centres), dense @ centres.T, atol=1e-3)
    some = np.array([3, 7, 29])
    assert np.allclose(rows.pick(some).cosines(centres), dense[some] @ centres.T, atol=1e-3)
    chosen = np.arange(30) % 4 == 1
    assert np.allclose(rows.total(chosen), dense[chosen].sum(0), atol=1e-4) and np.array_equal(rows.dense(5), dense[5])
