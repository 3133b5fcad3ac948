"""Packing and record files against the tokenizer itself."""

import struct
import zlib
from collections import defaultdict

import numpy as np
import pytest

from pageprism.llm import packing, records, tokens
from tests.llm.helpers import odd_docs

SF = "/root/testdata/sf0.001"


def whole(texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokens.default_tokenizer())
    return [t.encode(x or "", add_special_tokens=False).ids for x in texts]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_chunks_give_the_ids_of_the_whole_text(name):
    import public_tokenizers
    from tokenizers import Tokenizer

    texts = ["", "a b", "Don't STOP\n\n it's 3.14\x0bx", "<|endoftext|> <|ENDOFTEXT|>a", "é ́x   ΑΣ ΑΣ.", "İI KK", "x" * 3000]
    path = public_tokenizers.path(name)
    coder = tokens.TextEncoder(tokens.tokenizer_text(path), most_chunks=3)
    plain = Tokenizer.from_file(path)
    for _ in range(2):
        ids, counts = coder.encode([t.encode() for t in texts])
        assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == [
            plain.encode(t, add_special_tokens=False).ids for t in texts]


def test_words_before_marks_are_learned_once():
    from tokenizers import Tokenizer

    texts = ["word. word, word!! word### (word) word's word", "né. né; né", "don't-stop... it.'s 's. a<|endoftext|>b. <|endoftext|>.", "x.y 3.5, 7.", "a=\u0338 b", "a", ".", "", "é"]
    coder, plain = tokens.TextEncoder(tokens.tokenizer_text(tokens.default_tokenizer())), Tokenizer.from_file(tokens.default_tokenizer())
    ids, counts = coder.encode([t.encode() for t in texts])
    assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == [plain.encode(t, add_special_tokens=False).ids for t in texts]
    assert not {b"word.", b"word,", b"word!!", b"word###", "né.".encode()} & set(coder.index)


def test_chunks_that_come_again_stay():
    coder = tokens.TextEncoder(tokens.tokenizer_text(tokens.default_tokenizer()), most_chunks=8)
    first, _ = coder.encode([b"often seldom"])
    coder.encode([b"often a b c d e f g h"])
    coder.encode([b"x"])
    assert b"often" in coder.index and b"seldom" not in coder.index
    assert coder.encode([b"often seldom"])[0].tolist() == first.tolist()


def test_long_texts_are_sliced_at_blanks():
    text = ("ab cd\n" * 400_000).encode()
    assert b"".join(tokens.slices(text)) == text and len(list(tokens.slices(text))) > 2
    assert list(tokens.slices(b"x" * 3_000_000)) == [b"x" * 3_000_000]


def test_assign_fills_sequences():
    rng = np.random.default_rng(1)
    lengths = rng.integers(1, 9000, 500)
    placed = packing.assign(lengths, 4096)
    used = defaultdict(int)
    for d, start, n, seq, offset in placed:
        assert offset == used[seq]
        used[seq] += n
    assert max(used.values()) <= 4096 and len(used) <= -(-lengths.sum() // 4096) + 1
    for d, n in enumerate(lengths):
        own = sorted((s, k) for e, s, k, *_ in placed if e == d)
        assert [s for s, _ in own] == np.concatenate([[0], np.cumsum([k for _, k in own])[:-1]]).tolist() and sum(k for _, k in own) == n


def test_costs_are_balanced():
    lengths = np.array([2000] * 40 + [100] * 800)
    spent = defaultdict(float)
    for _, _, n, seq, _ in packing.assign(lengths, 4096):
        spent[seq] += packing.cost(n)
    assert max(spent.values()) < 1.6 * min(spent.values())


def check_pieces(rows, texts, end):
    by = defaultdict(list)
    for r in rows:
        by[r.doc_id].append(r)
    want = defaultdict(list)
    for key, ids in texts:
        want[key].append(ids + [end])
    assert set(by) == set(want)
    for key, own in by.items():
        copies = len(want[key])
        assert sum(r.length for r in own) == sum(map(len, want[key]))
        whole_ids = want[key][0]
        for r in own:
            assert r.doc_tokens == len(whole_ids)
            part = np.array(whole_ids[r.start:r.start + r.length], "<u4").tobytes()
            assert r.ids_crc32 == zlib.crc32(part)
        assert len({r.start for r in own}) * copies == len(own)


def test_pack_odd_rows(spark):
    from pyspark.sql import functions as F

    docs = odd_docs(spark)
    rows = packing.pack(docs, window_sequences=3).withColumn("ids_crc32", F.crc32("ids")).collect()
    given = docs.select("doc_id", "text").collect()
    check_pieces(rows, list(zip([r.doc_id for r in given], whole([r.text for r in given]))), 2)
    seqs = defaultdict(list)
    for r in rows:
        seqs[r.sequence_id].append((r.offset, r.length))
    for own in seqs.values():
        own.sort()
        assert [o for o, _ in own] == np.concatenate([[0], np.cumsum([n for _, n in own])[:-1]]).tolist()
        assert sum(n for _, n in own) <= 4096
    assert packing.pack(docs.limit(0)).count() == 0


def test_packing_query_is_whole_and_tight(spark):
    rows = packing.op3_packing(spark, SF).collect()
    given = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    check_pieces(rows, list(zip([r.doc_id for r in given], whole([r.text for r in given]))), 2)
    total = sum(r.length for r in rows)
    assert len({r.sequence_id for r in rows}) <= total // 4096 + 2


def test_record_round_trip_and_checks():
    data = records.record(7, np.array([1, 2, 65535]), 2) + records.record(None, np.array([], int), 2)
    key, ids, at = records.parse(data, 0)
    assert (key, ids.tolist()) == (7, [1, 2, 65535]) and records.parse(data, at)[0] is None
    for i in range(len(data) - 1):
        bad = bytearray(data)
        bad[i] ^= 1
        with pytest.raises((ValueError, struct.error)):
            at = 0
            while at < len(bad):
                *_, at = records.parse(bytes(bad), at)
            raise ValueError


def test_records_odd_rows(spark, tmp_path):
    docs = odd_docs(spark)
    path = f"file://{tmp_path}/r"
    manifest = records.write_records(docs.repartition(3), path)
    rows = sorted(records.read_records(spark, path).collect(), key=lambda r: r.start)
    given = docs.select("doc_id", "text").collect()
    want = {(r.doc_id, np.array(ids + [1], "<u4").tobytes()) for r, ids in zip(given, whole([r.text for r in given]))}
    assert {(r.doc_id, bytes(r.ids)) for r in rows} == want and len(rows) == len(given)
    keys = [r.doc_id for r in rows]
    assert keys[0] is None and keys[1:] == sorted(keys[1:])
    assert [r.start for r in rows] == np.concatenate([[0], np.cumsum([r.n_tokens for r in rows])[:-1]]).tolist()
    mixed = records.read_shuffled(spark, path, 5).collect()
    assert sorted((str(r.doc_id), bytes(r.ids)) for r in mixed) == sorted((str(r.doc_id), bytes(r.ids)) for r in rows)
    assert [r.position for r in mixed] == sorted(r.position for r in mixed) and manifest.count() >= 1
    empty = f"file://{tmp_path}/e"
    records.write_records(docs.limit(0), empty)
    assert records.read_records(spark, empty).count() == 0


def test_records_query(spark):
    rows = sorted(records.op10_token_records(spark, SF).collect(), key=lambda r: r.doc_id)
    given = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect()
    start = 0
    for r, g, ids in zip(rows, given, whole([g.text for g in given])):
        assert (r.doc_id, r.start, r.n_tokens) == (g.doc_id, start, len(ids) + 1)
        assert r.ids_crc32 == zlib.crc32(np.array(ids + [1], "<u4").tobytes())
        start += r.n_tokens
    assert len(rows) == len(given)
