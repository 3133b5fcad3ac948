"""Pseudo-likelihood scores against direct computation."""

import random
from collections import Counter

import numpy as np
import pyarrow as pa

from pageprism.llm import pseudo_lm
from tests.llm.helpers import odd_docs

SF = "/root/testdata/sf0.01"


def test_scores_are_sums_of_conditional_log_probabilities():
    net = pseudo_lm.Network.fresh(1)
    docs = [bytes([5, 9, 200, 7]), b"", bytes(range(1, 120)) * 200, bytes([3])]
    found = pseudo_lm.score_documents(docs, net, net.position_tables())
    for doc, value in list(zip(docs, found))[:2] + [(docs[3], found[3])]:
        total = 0.0
        padded = [0, 0, *doc, 0, 0]
        for i, token in enumerate(doc):
            seen = padded[i:i + 2] + padded[i + 3:i + 5]
            hidden = np.maximum(sum(net.embed[c] @ w for c, w in zip(seen, net.inner)) + net.bias, 0)
            g, m = divmod(token, pseudo_lm.GROUP)
            for logits, k in ((hidden @ net.group + net.group_bias, g), (hidden @ net.member[g] + net.member_bias[g], m)):
                total += float(logits[k]) - np.log(np.exp(logits.astype(float)).sum())
        assert np.isclose(value, total, atol=1e-4)
    alone = pseudo_lm.score_documents([docs[2]], net, net.position_tables())[0]
    assert np.isclose(found[2], alone)


def test_training_beats_chance_and_order_matters(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = pseudo_lm.pseudo_likelihood(docs, rounds=3, every=8).collect()
    assert len(rows) == docs.count()
    total = sum(r.log_likelihood for r in rows) / sum(r.n_tokens for r in rows)
    words = [w for r in docs.collect() for w in r.text.lower().split()]
    frequent = [bytes(r.word) for r in pseudo_lm.word_counts(docs).orderBy("n", ascending=False).limit(pseudo_lm.FREQUENT).collect()]
    classes = pseudo_lm.Classes(frequent)
    counts = np.bincount([classes[w.encode()] for w in words], minlength=256)
    p = counts[counts > 0] / counts.sum()
    assert total > (p * np.log(p)).sum() + 0.1  # better than the frequencies alone


def test_structure_is_learned(spark):
    rng = random.Random(1)
    letters = "abcdefgh"

    def ordered(n):
        start = rng.randrange(8)
        return " ".join(letters[(start + i) % 8] for i in range(n))
    docs = [(i, ordered(60)) for i in range(400)] + [(1000 + i, " ".join(rng.choice(letters) for _ in range(60))) for i in range(20)]
    rows = {r.doc_id: r for r in pseudo_lm.pseudo_likelihood(spark.createDataFrame(docs, "doc_id long, text string"), rounds=4, every=2).collect()}
    good = np.mean([rows[i].mean_log_likelihood for i in range(400)])
    bad = np.mean([rows[1000 + i].mean_log_likelihood for i in range(20)])
    assert good > bad + 1


def test_odd_rows(spark):
    docs = odd_docs(spark)
    rows = pseudo_lm.pseudo_likelihood(docs).collect()
    assert len(rows) == docs.count()
    by = {r.doc_id: r for r in rows}
    assert all(by[k].n_tokens == 0 and by[k].log_likelihood == 0 and by[k].mean_log_likelihood is None for k in (2, 3, 4))
    assert by[5].n_tokens == 27_000 and len({r.log_likelihood for r in rows if r.doc_id == 5}) == 1
    assert pseudo_lm.pseudo_likelihood(docs.limit(0)).count() == 0


def test_word_counts(spark):
    docs = spark.createDataFrame([("A b\ta",), (None,), ("é É b",)], "text string")
    assert {bytes(r.word).decode(): r.n for r in pseudo_lm.word_counts(docs).collect()} == {"a": 2, "b": 2, "é": 1, "É": 1}


def test_words_of_a_class_differ(spark):
    docs = [(i, "lorem ipsum " * 20 + " ".join(f"f{k}x" for k in range(130)) + " common" * 30) for i in range(30)]
    docs += [(100, "lorem common ipsum"), (101, "lorem zzcommon ipsum")]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    rows = {r.doc_id: r for r in pseudo_lm.pseudo_likelihood(frame).collect()}
    n = Counter(w for _, t in docs for w in t.split())
    frequent = sorted(n, key=lambda w: (-n[w], w))[:pseudo_lm.FREQUENT]
    classes = pseudo_lm.Classes([w.encode() for w in frequent])
    own = [w for w in n if w not in frequent]
    totals = Counter()
    for w in own:
        totals[classes[w.encode()]] += n[w]
    for i, t in docs:
        want = sum(np.log(n[w] / (totals[classes[w.encode()]] + 1)) for w in t.split() if w in own)
        assert np.isclose(rows[i].word_log_likelihood - rows[i].log_likelihood, want)
    assert rows[101].word_log_likelihood < rows[100].word_log_likelihood


def test_words_beyond_the_sent_ones_are_joined(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(100)
    gap = lambda: {r.doc_id: r.word_log_likelihood - r.log_likelihood for r in pseudo_lm.pseudo_likelihood(docs).collect()}
    whole = gap()
    monkeypatch.setattr(pseudo_lm, "KNOWN", 200)
    few = gap()
    assert whole.keys() == few.keys() and all(np.isclose(whole[k], few[k]) for k in whole)


def test_every_token_is_a_target_in_production(spark, monkeypatch):
    assert pseudo_lm.EVERY <= pseudo_lm.ROUNDS
    at = np.arange(1000)
    assert sorted(np.concatenate([at[r % pseudo_lm.EVERY::pseudo_lm.EVERY] for r in range(pseudo_lm.ROUNDS)])) == list(at)
    docs = spark.createDataFrame([(i, "a b c d e f g h " * 5) for i in range(200)] + [(999, "d a h b g c f e " * 5)], "doc_id long, text string")
    rows = {r.doc_id: r for r in pseudo_lm.pseudo_likelihood(docs).collect()}
    assert rows[0].mean_log_likelihood > rows[999].mean_log_likelihood + 0.5


def test_probabilities_of_all_tokens_add_up_to_one():
    net = pseudo_lm.Network.fresh(2)
    contexts = np.tile(np.array([[3], [70], [255], [0]], np.uint8), 256)
    logs = net.log_probabilities(contexts, np.arange(256, dtype=np.uint8), net.position_tables())
    assert np.isclose(np.exp(logs).sum(), 1, atol=1e-4)


def test_gradients():
    """A step against gradients by differences: Adam's first step moves each parameter by the rate against the sign of its gradient."""
    rng = np.random.default_rng(0)
    contexts, tokens = rng.integers(0, 256, (4, 300)).astype(np.uint8), rng.integers(0, 256, 300).astype(np.uint8)
    net, before = pseudo_lm.Network.fresh(4), pseudo_lm.Network.fresh(4)
    loss = lambda n: -n.log_probabilities(contexts, tokens, n.position_tables()).mean()
    net.step(contexts, tokens, [(np.zeros_like(p), np.zeros_like(p)) for p in net.parameters()], 1)
    for old, new, p in zip(before.parameters(), net.parameters(), pseudo_lm.Network.fresh(4).parameters()):
        assert old.shape == new.shape == p.shape
    for k, old in enumerate(before.parameters()):
        for at in rng.integers(0, old.size, 6):
            probe = pseudo_lm.Network.fresh(4)
            flat = probe.parameters()[k].reshape(-1)
            flat[at] += 0.02
            high = loss(probe)
            flat[at] -= 0.04
            slope = high - loss(probe)
            if abs(slope) > 2e-5:
                assert np.sign(net.parameters()[k].reshape(-1)[at] - old.reshape(-1)[at]) == -np.sign(slope)


def test_result_is_independent_of_partitions_and_order(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").limit(300)
    score = lambda d: {r.doc_id: r.log_likelihood for r in pseudo_lm.pseudo_likelihood(d).collect()}
    one, two = score(docs.repartition(1)), score(docs.repartition(7).sortWithinPartitions("text"))
    assert one.keys() == two.keys() and all(np.isclose(one[k], two[k], rtol=1e-4, atol=1e-2) for k in one)


def test_shards_are_kept_apart():
    import pyarrow as pa

    rows = [(1, b"a"), (1, b"b"), (2, b"c"), (5, b"d"), (5, b"e")]
    batches = [pa.RecordBatch.from_pydict({"shard": [s for s, _ in part], "tokens": [t for _, t in part]}) for part in (rows[:1], rows[1:4], rows[4:])]
    assert [[d for g in groups for d in g] for groups in pseudo_lm._shards(iter(batches))] == [[b"a", b"b"], [b"c"], [b"d", b"e"]]


def test_encoded_texts_equal_those_word_by_word(spark):
    texts = [(1, "  b a\tA b zz zz yx\n"), (2, None), (3, ""), (4, " \n"), (5, "zz é É c."), (6, "a"), (None, "yx yx q")]
    frequent, known = [b"a", b"b"], {b"zz": -0.5, b"c.": -2.25}
    classes, totals = pseudo_lm.Classes(frequent), {t: 7 for t in range(256)}
    rows = {r.doc_id: r for r in pseudo_lm.encode(spark.createDataFrame(texts, "doc_id long, text string").coalesce(1), frequent, known, totals).collect()}
    for key, text in texts:
        words = (text or "").encode().lower().split()
        rest = {pseudo_lm._name(w): words.count(w) for w in words if w not in known and classes[w] > pseudo_lm.FREQUENT}
        assert bytes(rows[key].tokens) == bytes(classes[w] for w in words)
        assert rows[key].known_log == sum(known.get(w, 0.0) for w in words)
        assert {r.name % (1 << 64): r.n for r in rows[key].rest} == rest and all(r.unseen == -np.log(8) for r in rows[key].rest)


def test_one_vector_of_parameters_learns_as_its_parts():
    rng = np.random.default_rng(6)
    contexts, tokens = rng.integers(0, 256, (4, 300), np.uint8), rng.integers(0, 256, 300, np.uint8)
    parts = pseudo_lm.Network.fresh(5)
    state = [(np.zeros_like(p), np.zeros_like(p)) for p in parts.parameters()]
    values = pseudo_lm.Network.fresh(5).flat()
    whole, m, v = pseudo_lm.Network.of(values), np.zeros_like(values), np.zeros_like(values)
    for t in (1, 2, 3):
        parts.step(contexts, tokens, state, t)
        pseudo_lm._adam(values, np.concatenate([g.reshape(-1) for g in whole.gradients(contexts, tokens)]), m, v, t)
    assert np.array_equal(parts.flat(), values) and np.array_equal(whole.flat(), values)


def test_softmax_by_columns_is_that_of_rows_to_the_last_bit():
    rng = np.random.default_rng(7)
    logits = rng.normal(0, 20, (1000, pseudo_lm.GROUP)).astype(np.float32)
    wanted, given = rng.integers(0, pseudo_lm.GROUP, 1000), logits.copy()
    top, columns, total = pseudo_lm._exponents(logits)
    rows = np.exp(logits - logits.max(1)[:, None])
    assert np.array_equal(top, logits.max(1)) and np.array_equal(columns, rows.T) and np.array_equal(total, rows.sum(1))
    error = rows / rows.sum(1, keepdims=True)
    error[np.arange(1000), wanted] -= 1
    assert np.array_equal(pseudo_lm._softmax_error(logits, wanted, 1000), error / 1000)
    assert np.array_equal(pseudo_lm._log_softmax(logits, wanted), logits[np.arange(1000), wanted] - logits.max(1) - np.log(rows.sum(1)))
    assert np.array_equal(logits, given)


def test_columns_of_words_are_listed_whole():
    words = [b"", b"a", b"\xc3\xa9\x00", b"\xff\x1c\x85", b"", b"b" * 300, b""]
    column = pa.array([b"before", *words, b"behind"], pa.binary())
    assert pseudo_lm._listed(column.slice(1, len(words))) == words
    assert pseudo_lm._listed(column.slice(0, 0)) == [] and pseudo_lm._listed(column.slice(1, 1)) == [b""]
    assert pseudo_lm._names([b"", b"a"]).view(np.uint64).tolist() == [0xEF46DB3751D8E999, 0xD24EC4F1A98C6E5B]


def test_classes_of_many_words_are_those_of_each():
    rng = random.Random(5)
    words = [b"", b"a", b"\xff", b"the", *(bytes(rng.randrange(33, 256) for _ in range(rng.randrange(6))) for _ in range(5000)), b"\xc3\xa9", b"of", b""]
    frequent = [b"the", b"a", b"of", b"\xc3\xa9"]
    assert pseudo_lm.Classes(frequent).of(words).tolist() == [pseudo_lm.Classes(frequent)[w] for w in words]
    assert pseudo_lm.Classes(frequent).of([]).tolist() == []
