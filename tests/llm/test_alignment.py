import hashlib
from collections import defaultdict

import pytest

from pageprism.llm.alignment import Coders, align_tokenizers, byte_letters, default_paths, op12_alignment
from tests.llm.helpers import odd_docs

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.fixture(scope="module")
def libraries():
    import sentencepiece
    from tokenizers import Tokenizer

    a_path, b_path = default_paths()
    a = Tokenizer.from_file(a_path)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=b_path)


def plain(rows, libraries):
    """The contract, one document and one token at a time."""
    a, b = libraries
    letters = byte_letters()
    held, linked_in = [], defaultdict(int)
    for doc_id, text in rows:
        groups = []
        if text:
            wanted = (" " + text).encode()
            x = [(i, bytes(letters[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids]
            y = [(i, bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()) for i in b.encode(text)]
            if b"".join(t for _, t in x) == wanted == b"".join(t for _, t in y):
                ends = [set(), set()]
                for k, tokens in enumerate((x, y)):
                    at = 0
                    for _, t in tokens:
                        at += len(t)
                        ends[k].add(at)
                cuts = sorted(ends[0] & ends[1])
                for low, high in zip([0] + cuts, cuts):
                    own = []
                    for tokens in (x, y):
                        at, ids = 0, []
                        for i, t in tokens:
                            at += len(t)
                            if low < at <= high:
                                ids.append(i)
                        own.append(ids)
                    groups.append(own)
        held.append((doc_id, groups))
        for pair in {(i, j) for p, q in groups for i in p for j in q}:
            linked_in[pair] += 1
    best = defaultdict(int)
    for (i, _), n in linked_in.items():
        best[i] = max(best[i], n)
    out = []
    for doc_id, groups in held:
        links = [(i, j) for p, q in groups for i in p for j in q]
        shown = ";".join(f"{','.join(map(str, p))}|{','.join(map(str, q))}" for p, q in groups)
        out.append((doc_id, sum(len(p) for p, _ in groups), sum(len(q) for _, q in groups), len(groups), len(links),
                    sum(linked_in[x] == best[x[0]] for x in links), sum(linked_in[x] for x in links),
                    hashlib.sha256(shown.encode()).hexdigest() if groups else ""))
    return out


def ordered(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: (r[0] is None, r[0] or 0, r[1:]))


TEXTS = ["Hello world", "hello <|endoftext|> <s> </s>", "été à la plage, naïveté", "漢字 🙂🙂 한", "a  b\n\n\tc  ", "▁ block ▁▁", "x" * 3000, "xyx xyyx abcabc",
         " leading", "trailing ", "\u0085   z", "don't can't WON'T", "1234567890 12.5e10", "Hello world", None, "", "-" * 257 + "=" * 129, "\x00\x01", "ﬁ ½"]


@pytest.mark.parametrize("heavy", [200_000, 3])
def test_equals_brute_force(heavy, spark, libraries):
    rows = list(enumerate(TEXTS)) + [(100, "Hello world"), (None, "abc def"), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = align_tokenizers(docs, heavy=heavy)
    assert found.columns == COLUMNS
    assert ordered(found.collect()) == ordered(plain(rows, libraries))


def test_registered_query(spark, libraries):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert ordered(op12_alignment(spark, SF).collect()) == ordered(plain(rows, libraries))


def test_ranks_give_the_ids_of_the_library(libraries):
    with open(default_paths()[0], encoding="utf-8") as f, open(default_paths()[1], "rb") as g:
        coders = Coders(f.read(), g.read())
    assert coders.fast is not None
    points = [chr(c) for c in range(0x300)]
    texts = [f" a{x}{y}1 {x}b{y}{y} '{x}s" for x in points for y in (" ", "a", "é", " ", "\n", "'", "\x85")]
    assert [coders.fast.encode_ordinary(t) for t in texts] == [e.ids for e in libraries[0].encode_batch(texts, add_special_tokens=False)]


def test_same_bytes_array(libraries):
    with open(default_paths()[0], encoding="utf-8") as f, open(default_paths()[1], "rb") as g:
        coders = Coders(f.read(), g.read())
    hit = [(i, j) for i, j in enumerate(coders.same.tolist()) if j >= 0]
    assert len(hit) > 5000
    assert all(coders.a_bytes[i] == coders.b_bytes[j] for i, j in hit)


def test_odd_rows(spark, libraries):
    docs = odd_docs(spark).where("text is null or length(text) < 60000")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert ordered(align_tokenizers(docs).collect()) == ordered(plain(rows, libraries))
    assert align_tokenizers(docs.limit(0)).count() == 0
