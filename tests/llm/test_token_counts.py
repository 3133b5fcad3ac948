import random

import public_tokenizers
import pytest

from pageprism.llm import token_counts
from pageprism.llm.token_counts import chunk_ranges, count_tokens, op13_token_counts
from tests.llm.helpers import odd_docs

SF = "/root/testdata/sf0.001"
FILES = ["word_bpe_49k.json", "byte_bpe_50k.json", "piece_bpe_32k.model"]


def library_count(name):
    path = public_tokenizers.path(name)
    if name.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda text: len(model.encode(text))
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    return lambda text: len(tokenizer.encode(text, add_special_tokens=False).ids)


def long_texts():
    rng = random.Random(5)
    words = ["the", "it's", "''s", "<|endoftext|>", "<|startoftext|>", "İstanbul", "é", "né", "12,345", "  ", "\n\n", "\t", "🙂🙂", "don't", "漢字",
             "한", "▁", "<s>", "x" * 30, "aaaa", "…", " ", "ﬁ", "A"]
    texts = ["".join(rng.choice(words) + rng.choice([" ", " ", "", "\n"]) for _ in range(2500)) for _ in range(6)]
    texts.append("x" * 9000)
    texts.append("ab " * 4000)
    texts.append(" " * 9000)
    texts.append("漢字かな" * 2500)
    texts.append("é" * 5000)
    texts.append("''s" * 3000)
    texts.append("<|endoftext|>" * 900)
    texts.append("".join(chr(rng.randrange(0x20, 0x2500)) for _ in range(9000)))
    return texts


@pytest.mark.parametrize("name", FILES)
def test_spliced_counts_equal_the_library(name, spark):
    texts = long_texts() + ["short", "", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = count_tokens(docs, public_tokenizers.path(name), chunk_chars=1500, overlap_chars=300).collect()
    count = library_count(name)
    assert {(r.doc_id, r.n_tokens) for r in found} == {(i, count(t or "")) for i, t in enumerate(texts)}
    assert {(r.doc_id, r.n_bytes) for r in found} == {(i, len((t or "").encode())) for i, t in enumerate(texts)}


def test_most_seams_need_no_wider_overlap(spark, monkeypatch):
    seen = []
    real = token_counts.splice
    monkeypatch.setattr(token_counts, "splice", lambda zones: seen.append(1) or real(zones))
    docs = spark.createDataFrame([(1, "some words of plain prose, repeated often. " * 5000)], "doc_id long, text string")
    assert count_tokens(docs).first().n_tokens == library_count(FILES[0])("some words of plain prose, repeated often. " * 5000)
    assert len(seen) == 1


def test_long_run_without_cuts_widens_until_whole(spark, monkeypatch):
    seen = []
    real = token_counts.splice
    monkeypatch.setattr(token_counts, "splice", lambda zones: seen.append(1) or real(zones))
    docs = spark.createDataFrame([(1, "x" * 20_000)], "doc_id long, text string")
    assert count_tokens(docs, chunk_chars=1000, overlap_chars=200).first().n_tokens == library_count(FILES[0])("x" * 20_000)
    assert len(seen) > 1


def test_ranges_cover_and_overlap():
    ranges = chunk_ranges(10_000, 1000, 200)
    assert ranges[0][0] == 0 and ranges[-1][1] == 10_000
    assert all(a < c < b for (a, b), (c, _) in zip(ranges, ranges[1:]))
    assert all(b - c == 200 for (_, b), (c, _) in zip(ranges, ranges[1:]))
    assert chunk_ranges(0, 1000, 200) == [(0, 0)]


def test_registered_query(spark):
    count = library_count(FILES[0])
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    found = op13_token_counts(spark, SF)
    assert found.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    rows = found.collect()
    assert len(rows) == len(docs)
    for r in rows:
        assert (r.n_bytes, r.n_tokens) == (len(docs[r.doc_id].encode()), count(docs[r.doc_id]))
        assert r.over_limit == (r.n_tokens > 2048)


def test_odd_rows(spark):
    docs = odd_docs(spark)
    count = library_count(FILES[0])
    expected = sorted((r.doc_id is None, r.doc_id, count(r.text or "")) for r in docs.collect())
    found = sorted((r.doc_id is None, r.doc_id, r.n_tokens) for r in count_tokens(docs, chunk_chars=5000).collect())
    assert found == expected
    assert count_tokens(docs.limit(0)).count() == 0


def test_rejects_overlaps_without_room(spark):
    with pytest.raises(ValueError):
        count_tokens(odd_docs(spark), overlap_chars=100)
