"""Secret scan against the plain rules, and the network on held-out findings."""

import hashlib
import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from pageprism.llm import secret_scan
from tests.llm.helpers import odd_docs

SF = "/root/testdata/sf0.01"


def plain(text):
    found = []
    key = "|".join("".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in w) for w in ("password", "passwd", "secret", "token", "api_?key"))
    for m in re.finditer(rf"""({key})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text):
        if len(m[2]) >= 6:
            found.append((m.start(), 0, "assign", m.end()))
    for m in re.finditer(r"AKIA[A-Z0-9]+", text):
        if len(m[0]) >= 20:
            found.append((m.start(), 1, "access", m.end()))
    for m in re.finditer(r"[0-9a-f]+", text):
        if len(m[0]) >= 24:
            found.append((m.start(), 2, "hex", m.end()))
    return [(s, e, k) for s, _, k, e in sorted(found)]


PARTS = st.sampled_from(["password", "API_KEY", "token", '"', "'", " ", "=", ":", "abc123", "AKIA", "ABCDEFGHIJKLMNOP1", "é", "\n", "deadbeef" * 3,
                         "a" * 24, "secret", "ſecret", "x", "0f", "\0", "A" * 16])


@settings(max_examples=400, deadline=None)
@given(st.lists(st.lists(PARTS, max_size=9).map("".join), min_size=1, max_size=4))
def test_base_spans_and_quick_test(texts):
    ok = secret_scan.may_hold([t.encode() for t in texts])
    for text, may in zip(texts, ok):
        assert secret_scan.base_spans(text) == plain(text)
        assert may or not (plain(text) or secret_scan.candidates(text))


def test_query_on_whole_texts(spark):
    rows = {r.doc_id: r for r in secret_scan.op2_secret_scan(spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    assert len(rows) == len(docs)
    for d in docs:
        spans, r = plain(d.text or ""), rows[d.doc_id]
        joined = ",".join(f"{k}:{s}:{e}" for s, e, k in spans)
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(x[2] == k for x in spans) for k in ("assign", "access", "hex")]
        kept = [x for x in r.spans.split(",") if x and not x.startswith("network")]
        assert ",".join(kept) == joined
    assert any(r.n_assign for r in rows.values())


def items(texts):
    out = []
    for t in texts:
        out += [secret_scan.encode(t, *c) for c in secret_scan.candidates(t)]
    return out


def test_network_finds_held_out_secrets():
    rng = np.random.default_rng(2)
    letters = np.array(list("abcdefghijklmnopqrstuvwxyz0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
    secret = lambda: "auth: key " + "".join(rng.choice(letters, 28)) + "4x end"
    clean = lambda: "see www.shop-" + "".join(rng.choice(letters[:26], 9)) + ".com/item-12 now"
    good, bad = items([secret() for _ in range(300)]), items([clean() for _ in range(300)])
    mixed = [x for p in zip(good, bad) for x in p]
    order = rng.permutation(len(mixed))
    net = secret_scan.fit([mixed[i] for i in order], np.array([1 - i % 2 for i in order]))
    assert (net.probabilities(items([secret() for _ in range(100)])) >= net.threshold).mean() >= 0.97
    assert (net.probabilities(items([clean() for _ in range(100)])) >= net.threshold).mean() <= 0.03
    text = f"before {secret()} after"
    spans = secret_scan.scan_text(text, net)
    assert [k for *_, k in spans] == ["network"]
    assert secret_scan.replaced(text, spans, "#") == text[:spans[0][0]] + "#" + text[spans[0][1]:]


def test_pooling_does_not_depend_on_pieces():
    net = secret_scan.Network.fresh()
    symbols = np.random.default_rng(1).integers(1, 97, 9001)
    inside = np.ones(9001, bool)
    index = np.concatenate([[0, 0], symbols + secret_scan.SYMBOLS, [0, 0]])
    whole = np.stack([net.embed[index[i:i + 5]].reshape(-1) @ net.kernel for i in range(9001)]).max(0)
    assert np.allclose(net.pooled(symbols, inside), np.maximum(whole + net.bias, 0))


def test_untrained_or_one_label_adds_nothing(spark):
    net = secret_scan.train(odd_docs(spark).limit(2))
    rows = secret_scan.scan(odd_docs(spark), net).collect()
    assert len(rows) == odd_docs(spark).count() and not any(r.secret_spans for r in rows) and rows[0].start == 7
    assert secret_scan.scan(odd_docs(spark).limit(0), net).count() == 0


def test_redact_keeps_rows_and_columns(spark):
    docs = spark.createDataFrame([(1, "say password=abcdef1 now", 24, 9), (2, None, None, 9), (3, "clean é", 7, 9)],
                                 "doc_id long, text string, n_chars long, kind int")
    rows = {r.doc_id: r for r in secret_scan.redact(docs, secret_scan.Network.fresh()).collect()}
    assert rows[1].text == "say [SECRET] now" and rows[1].n_chars == 16 and rows[2].text is None and rows[3].text == "clean é"
    assert rows[3].kind == 9


def test_recall_alone_sets_the_threshold():
    rng = np.random.default_rng(4)
    labels = np.arange(1000) % 2
    scores = labels + rng.normal(0, 1, 1000)  # the labels overlap: precision 0.9 and recall 0.99 exclude each other
    net = secret_scan.Network.fresh()
    secret_scan._calibrate(net, scores, labels.astype(float), (9900, 100))
    p = 1 / (1 + np.exp(-(net.slope * scores + net.shift)))
    assert 0.99 <= (p[labels == 1] >= net.threshold).mean() <= 0.992
    false = (p[labels == 0] >= net.threshold).mean()
    assert np.isclose(net.precision, 0.01 * 0.99 / (0.01 * 0.99 + 0.99 * false), rtol=0.01)


def test_all_findings_are_learned_in_shards(spark):
    rng = np.random.default_rng(6)
    letters = np.array(list("abcdefghijklmnopqrstuvwxyz0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
    run = lambda n: "".join(rng.choice(letters, n))
    texts = [f"use password={run(28)}4x now" for _ in range(300)] + [f"see www.shop-{run(9).lower()}.com/item-12 now" for _ in range(700)]
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    net, again = secret_scan.train(docs, shard=200), secret_scan.train(docs.repartition(3), shard=200)
    assert all(np.array_equal(a, b) for a, b in zip(net.parameters(), again.parameters())) and net.threshold == again.threshold
    found = net.probabilities(items(texts)) >= net.threshold
    labels = np.array([int(t.startswith("use")) for t in texts])
    assert found[labels == 1].mean() >= 0.97 and found[labels == 0].mean() <= 0.03


def test_table_and_array_calibrate_alike(spark):
    rng = np.random.default_rng(8)
    labels = np.arange(600) % 2
    scores = labels + rng.normal(0, 1, 600)
    a, b = secret_scan.Network.fresh(), secret_scan.Network.fresh()
    secret_scan._calibrate(a, scores, labels.astype(float), (900, 100))
    secret_scan._calibrate_table(b, spark.createDataFrame([(int(x), float(y)) for x, y in zip(labels, scores)], "label int, score double"), (900, 100))
    assert np.allclose([a.slope, a.shift, a.threshold, a.precision], [b.slope, b.shift, b.threshold, b.precision], atol=1e-4)
