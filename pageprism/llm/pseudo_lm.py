"""Masked pseudo-likelihood of documents by a bidirectional window network."""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import groupby, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pageprism.llm.common import TEXT_GROUP_BYTES, column_bytes, groups_by_bytes, map_batches, table
from pageprism.session import stored

CLASSES = 256
FREQUENT = 127
EDGE = 0
SIDE = 2
EMBED = 16
HIDDEN = 32
ROUNDS = 3
EVERY = 3  # with as many rounds: each token is a target once
RATE = 5e-3
BATCH = 1024
GROUP = 16
SHARD_TOKENS = 4 << 20  # tokens of a training shard: shards follow the corpus, not the cluster
MOST_WORDS = 500_000
KNOWN = 100_000  # words whose probabilities are sent to every task; those of all others are joined
_TOKENS = 8192


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n) over all whole texts; words are runs without ASCII blanks after folding A-Z."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for batch in batches:
            texts = column_bytes(batch.column(0))
            for a, b in groups_by_bytes(texts):
                for text in texts[a:b]:
                    held.update(text.lower().split())
                if len(held) > MOST_WORDS:
                    yield from _count_rows(held)
                    held = Counter()
        yield from _count_rows(held)

    counted = map_batches(docs.select(F.col("text").cast("string")), run, "word binary, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


def _count_rows(held: Counter) -> Iterator[pa.RecordBatch]:
    words, counts = list(held), list(held.values())
    for i in range(0, len(words), 50_000):
        yield pa.RecordBatch.from_arrays([pa.array(words[i:i + 50_000], pa.binary()), pa.array(counts[i:i + 50_000], pa.int64())], names=["word", "n"])


class Classes(dict):
    """Token of a word: the frequent words have one each, all others share those of their last two bytes."""

    def __init__(self, frequent: list[bytes]):
        super().__init__({w: i + 1 for i, w in enumerate(frequent)})

    def __missing__(self, word: bytes) -> int:
        token = FREQUENT + 1 + zlib.crc32(word[-2:]) % (CLASSES - FREQUENT - 1)
        if len(self) < MOST_WORDS:
            self[word] = token
        return token

    def of(self, words: list[bytes]) -> np.ndarray:
        """Tokens of many words, by their endings at once."""
        row, size = np.frombuffer(b"  " + b" ".join(words), np.uint8), np.fromiter(map(len, words), np.int64, len(words))
        end = 1 + np.cumsum(size + 1)
        last = row[end - 1].astype(np.int64)
        ending = np.where(size > 1, 256 * row[end - 2].astype(np.int64) + last, (1 << 16) + np.where(size > 0, last, 256))
        own = np.fromiter(map(self.get, words, repeat(0)), np.uint8, len(words))
        return np.where(own > 0, own, _by_ending()[ending])


@lru_cache(maxsize=1)
def _by_ending() -> np.ndarray:
    """Token of a word that isn't frequent by its last two bytes; then by its only byte; then that of the empty word."""
    every = [bytes(divmod(i, 256)) for i in range(1 << 16)] + [bytes([i]) for i in range(256)] + [b""]
    return np.fromiter(map(Classes([]).__getitem__, every), np.uint8, len(every))


def _names(words: list[bytes]) -> np.ndarray:
    from xxhash import xxh64_intdigest

    return np.fromiter(map(xxh64_intdigest, words), np.uint64, len(words)).view(np.int64)


def _name(word: bytes) -> int:
    return int(_names([word]).view(np.uint64)[0])


def _listed(words: pa.Array) -> list[bytes]:
    """Values of a column of words. They hold no blanks, so they are joined by blanks and cut again, which is much faster than one by one."""
    if not len(words):
        return []
    return pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), words), b" ")[0].as_py().split(b" ")


def class_totals(counts: DataFrame, frequent: list[bytes]) -> dict[int, int]:
    """Occurrences of all words of each class that words share."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes, held = Classes(frequent), np.zeros(CLASSES, np.int64)
        for batch in batches:
            np.add.at(held, classes.of(_listed(batch.column(0))), batch.column(1).to_numpy())
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(CLASSES)), pa.array(held)], names=["class", "n"])

    summed = map_batches(counts.select("word", "n"), run, "class long, n long").groupBy("class").agg(F.sum("n").alias("n"))
    return {r["class"]: r.n for r in summed.where(F.col("class") > FREQUENT).collect()}


def word_logs(counts: DataFrame, frequent: list[bytes], totals: dict[int, int]) -> DataFrame:
    """(name, log): ln P(word | class) of every counted word that shares its class: n / (total + 1), which leaves 1 / (total + 1) for
    a word that was never counted. ``name`` is the XXH64 of the word."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes, all_of = Classes(frequent), np.array([totals.get(c, 0) + 1 for c in range(CLASSES)])
        for batch in batches:
            words = _listed(batch.column(0))
            at = classes.of(words)
            shared = at > FREQUENT
            logs = np.log(batch.column(1).to_numpy()[shared] / all_of[at[shared]])
            yield pa.RecordBatch.from_arrays([pa.array(_names(words)[shared]), pa.array(logs)], names=["name", "log"])

    return map_batches(counts.select("word", "n"), run, "name long, log double")


def encode(docs: DataFrame, frequent: list[bytes], known: dict[bytes, float] | None = None, totals: dict[int, int] | None = None) -> DataFrame:
    """doc_id and ``tokens``, a byte for each word of the whole text; ``known_log``, the sum of ln P(word | class) over the words in ``known``; and ``rest``, each
    other word that shares its class with its count and the value of a word that was never counted."""
    spark, known, totals = docs.sparkSession, known or {}, totals or {}
    sent = spark.sparkContext.broadcast(known)
    element = pa.struct([("name", pa.int64()), ("n", pa.int64()), ("unseen", pa.float64())])
    unseen = np.array([-np.log(totals.get(c, 0) + 1) for c in range(CLASSES)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes, known = Classes(frequent), sent.value
        for batch in batches:
            texts = column_bytes(batch.column(1))
            for a, b in groups_by_bytes(texts):
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), *encoded(texts[a:b], classes, known)], names=["doc_id", "tokens", "known_log", "rest"])

    def encoded(texts: list[bytes], classes: Classes, known: dict[bytes, float]) -> list[pa.Array]:
        split = pc.ascii_split_whitespace(pc.ascii_lower(pa.array(texts, pa.binary()).view(pa.string())))
        found = split.values.dictionary_encode()
        words = _listed(found.dictionary.view(pa.binary()))
        token = classes.of(words)
        value = np.fromiter(map(known.get, words, repeat(np.nan)), np.float64, len(words))
        at, owner = found.indices.to_numpy(), np.repeat(np.arange(len(texts)), np.diff(split.offsets.to_numpy()))
        if b"" in words:  # blanks at the ends of a text
            held = at != words.index(b"")
            at, owner = at[held], owner[held]
        ends = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(texts)))]).astype(np.int32)
        tokens = pa.Array.from_buffers(pa.binary(), len(texts), [None, pa.py_buffer(ends), pa.py_buffer(token[at])])
        logs = np.bincount(owner, np.nan_to_num(value)[at], len(texts))
        other = np.isnan(value) & (token > FREQUENT)
        pairs, n = np.unique(owner[other[at]] * np.int64(len(words)) + at[other[at]], return_counts=True)
        owners, own = np.divmod(pairs, max(1, len(words)))
        names = np.zeros(len(words), np.int64)
        names[other] = _names([words[i] for i in np.flatnonzero(other).tolist()])
        rows = pa.StructArray.from_arrays([pa.array(names[own]), pa.array(n.astype(np.int64)), pa.array(unseen[token[own]])], fields=list(element))
        starts = np.searchsorted(owners, np.arange(len(texts) + 1)).astype(np.int32)
        return [tokens, pa.array(logs.astype(np.float64)), pa.ListArray.from_arrays(pa.array(starts), rows)]

    return map_batches(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), run,
                       "doc_id long, tokens binary, known_log double, rest array<struct<name:long,n:long,unseen:double>>")


@dataclass
class Network:
    """Embeddings of the ``SIDE`` tokens on either side, a hidden layer, and the probability of a token as that of its group of ``GROUP`` tokens times
    that of the token in its group. The token itself isn't seen."""

    embed: np.ndarray
    inner: np.ndarray  # one matrix per position
    bias: np.ndarray
    group: np.ndarray
    group_bias: np.ndarray
    member: np.ndarray  # one matrix per group
    member_bias: np.ndarray

    @staticmethod
    def fresh(seed: int = 3) -> Network:
        rng = np.random.default_rng(seed)
        draw = lambda scale, *shape: rng.normal(0, scale, shape).astype(np.float32)
        groups = CLASSES // GROUP
        return Network(draw(0.3, CLASSES, EMBED), draw(0.15, 2 * SIDE, EMBED, HIDDEN), np.zeros(HIDDEN, np.float32), draw(0.1, HIDDEN, groups),
                       np.zeros(groups, np.float32), draw(0.1, groups, HIDDEN, GROUP), np.zeros((groups, GROUP), np.float32))

    def parameters(self) -> list[np.ndarray]:
        return [self.embed, self.inner, self.bias, self.group, self.group_bias, self.member, self.member_bias]

    def flat(self) -> np.ndarray:
        return np.concatenate([p.reshape(-1) for p in self.parameters()])

    @staticmethod
    def of(flat: np.ndarray) -> Network:
        made, at = [], 0
        for p in Network.fresh().parameters():
            made.append(flat[at:at + p.size].reshape(p.shape).astype(np.float32, copy=False))
            at += p.size
        return Network(*made)

    def position_tables(self) -> np.ndarray:
        return np.stack([self.embed @ w for w in self.inner])

    def hidden(self, contexts: np.ndarray, tables: np.ndarray) -> np.ndarray:
        hidden = tables[0].take(contexts[0], axis=0)
        for k in range(1, 2 * SIDE):
            hidden += tables[k].take(contexts[k], axis=0)
        hidden += self.bias
        return np.maximum(hidden, 0, out=hidden)

    def log_probabilities(self, contexts: np.ndarray, tokens: np.ndarray, tables: np.ndarray) -> np.ndarray:
        """Of each token given its sides. ``tables``: ``position_tables()``."""
        order, first = _by_group(tokens)
        hidden, wanted = self.hidden(contexts[:, order], tables), tokens[order]
        logits = hidden @ self.group
        logits += self.group_bias
        out = _log_softmax(logits, wanted // GROUP)
        out += _log_softmax(self._members(hidden, first), wanted % GROUP)
        found = np.empty_like(out)
        found[order] = out
        return found

    def _members(self, hidden: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Logits of the tokens of each row's group; rows lie by group."""
        logits = np.empty((len(hidden), GROUP), hidden.dtype)
        for g, (a, b) in enumerate(zip(first[:-1], first[1:])):
            if b > a:
                np.matmul(hidden[a:b], self.member[g], out=logits[a:b])
                logits[a:b] += self.member_bias[g]
        return logits

    def gradients(self, contexts: np.ndarray, tokens: np.ndarray) -> list[np.ndarray]:
        """Of the mean negative log-probability of a batch."""
        n = len(tokens)
        order, first = _by_group(tokens)
        contexts, tokens = contexts[:, order], tokens[order]
        hidden = self.hidden(contexts, self.position_tables())
        p = _softmax_error(hidden @ self.group + self.group_bias, tokens // GROUP, n)
        own = _softmax_error(self._members(hidden, first), tokens % GROUP, n)
        d_hidden = p @ self.group.T
        d_member, d_member_bias = np.zeros_like(self.member), np.zeros_like(self.member_bias)
        back = np.empty_like(d_hidden)
        for g, (a, b) in enumerate(zip(first[:-1], first[1:])):
            if b > a:
                np.matmul(hidden[a:b].T, own[a:b], out=d_member[g])
                np.add.reduce(own[a:b], 0, out=d_member_bias[g])
                np.matmul(own[a:b], self.member[g].T, out=back[a:b])
        d_hidden += back
        d_hidden *= hidden > 0
        d_tables = np.zeros((2 * SIDE, CLASSES, HIDDEN), np.float32)  # of the position tables: rows of like tokens are summed first
        at = (contexts + CLASSES * np.arange(2 * SIDE, dtype=np.uint16)[:, None]).reshape(-1)
        alike = np.argsort(at, kind="stable")
        at = at[alike]
        start = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
        d_tables.reshape(-1, HIDDEN)[at[start]] = np.add.reduceat(d_hidden.take(alike % n, axis=0), start)
        d_embed = sum(d @ w.T for d, w in zip(d_tables, self.inner))
        return [d_embed, np.stack([self.embed.T @ d for d in d_tables]), d_hidden.sum(0), hidden.T @ p, p.sum(0), d_member, d_member_bias]

    def step(self, contexts: np.ndarray, tokens: np.ndarray, state: list, t: int) -> None:
        """One Adam step on the mean negative log-probability of a batch."""
        for value, g, (m, v) in zip(self.parameters(), self.gradients(contexts, tokens), state):
            _adam(value, g, m, v, t)


def _adam(value: np.ndarray, g: np.ndarray, m: np.ndarray, v: np.ndarray, t: int) -> None:
    m += 0.1 * (g - m)
    v += 0.01 * (g * g - v)
    value -= RATE * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.99 ** t)) + 1e-8)


def _by_group(tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of tokens by group, and where each group begins in it."""
    groups = tokens // GROUP
    return np.argsort(groups, kind="stable"), np.concatenate([[0], np.cumsum(np.bincount(groups, minlength=CLASSES // GROUP))])


def _exponents(logits: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Largest logit of each row, e to the others less that one, as columns, and the sums of these: numpy folds a few long rows much faster than many
    short ones."""
    columns = np.ascontiguousarray(logits.T)
    top = columns.max(0)
    columns -= top
    np.exp(columns, out=columns)
    held = columns[:GROUP // 2] + columns[GROUP // 2:]  # in the order in which numpy adds a row of 16, so sums are the same to the last bit
    while len(held) > 1:
        held = held[::2] + held[1::2]
    return top, columns, held[0]


def _log_softmax(logits: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    top, _, total = _exponents(logits)
    return logits[np.arange(len(wanted)), wanted] - top - np.log(total)


def _softmax_error(logits: np.ndarray, wanted: np.ndarray, n: int) -> np.ndarray:
    """Gradient of the mean negative log-probability over ``n`` tokens."""
    _, error, total = _exponents(logits)
    error /= total
    error[wanted, np.arange(len(wanted))] -= 1
    error /= n
    return np.ascontiguousarray(error.T)


def windows(documents: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All tokens of some documents one after another, where each stands in a row with ``SIDE`` edges around every document, and that row."""
    lengths = np.fromiter(map(len, documents), np.int64, len(documents))
    edge = bytes([EDGE]) * SIDE
    row = np.frombuffer(edge + edge.join(documents) + edge, np.uint8)
    first = SIDE + np.concatenate([[0], np.cumsum(lengths + SIDE)[:-1]]) if len(lengths) else np.zeros(0, np.int64)
    at = np.repeat(first - np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths) + np.arange(lengths.sum()) if len(lengths) else np.zeros(0, np.int64)
    return at, lengths, row


def sides(row: np.ndarray, at: np.ndarray) -> np.ndarray:
    return np.stack([row.take(at + d) for d in (*range(-SIDE, 0), *range(1, SIDE + 1))])


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[Iterator[list[bytes]]]:
    """For each shard of a task its documents, in groups whose bounds depend on the shard's own rows alone."""
    rows = ((shard, tokens) for batch in batches for shard, tokens in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()))

    def groups(own) -> Iterator[list[bytes]]:
        held, size = [], 0
        for _, tokens in own:
            held.append(tokens)
            size += len(tokens)
            if size >= TEXT_GROUP_BYTES:
                yield held
                held, size = [], 0
        if held:
            yield held

    for _, own in groupby(rows, lambda r: r[0]):
        yield groups(own)


def train(encoded: DataFrame, rounds: int = ROUNDS, every: int = EVERY, seed: int = 3, shard_tokens: int = SHARD_TOKENS) -> Network:
    """Round r trains on the tokens r, r + ``every``, ... of all documents; with no more than ``rounds`` for ``every`` each token is a target.

    Documents are dealt by hash over shards of about ``shard_tokens`` tokens, in an order that only they decide; so the result doesn't depend on files, tasks
    or cores. In each round every shard starts from the same network, learns, and gives back its parameters; Spark
    averages them, weighted by the tokens learned from, and only the mean (some thousand numbers) reaches the driver.
    """
    spark = encoded.sparkSession
    flat = Network.fresh(seed).flat()
    shards = max(1, -(-(encoded.agg(F.sum(F.length("tokens"))).first()[0] or 0) // shard_tokens))
    place = F.xxhash64("tokens", F.col("doc_id"))
    dealt = encoded.where(F.length("tokens") > 0).select("tokens", place.alias("place"), F.pmod(place, F.lit(shards)).cast("int").alias("shard"))
    # One file, of one row group, for each shard: so no reader tears one.
    dealt = stored(dealt.repartitionById(shards, "shard").sortWithinPartitions("place", "tokens"), "shards")
    for number in range(rounds):
        start = spark.sparkContext.broadcast(flat)

        def run(batches: Iterator[pa.RecordBatch], number=number, start=start) -> Iterator[pa.RecordBatch]:
            for groups in _shards(batches):
                values, learned, t = start.value.copy(), 0, 0
                net, m, v = Network.of(values), np.zeros_like(values), np.zeros_like(values)  # the network's parameters lie in values
                rng = np.random.default_rng(seed + number)
                for documents in groups:
                    at, _, row = windows(documents)
                    at = rng.permutation(at[number % every::every])
                    for i in range(0, len(at), BATCH):
                        t += 1
                        grads = net.gradients(sides(row, at[i:i + BATCH]), row[at[i:i + BATCH]])
                        _adam(values, np.concatenate([g.reshape(-1) for g in grads]), m, v, t)
                    learned += len(at)
                values = values.astype(np.float64)
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(values))), pa.array(values * learned), pa.array(np.full(len(values), float(learned)))],
                                                 names=["i", "value", "learned"])

        rows = map_batches(dealt.select("shard", "tokens"), run, "i long, value double, learned double").where("learned > 0")
        mean = rows.groupBy("i").agg((F.sum("value") / F.sum("learned")).alias("value")).collect()
        if not mean:
            break
        flat = np.zeros(len(mean), np.float32)
        for r in mean:
            flat[r.i] = r.value
    return Network.of(flat)


def score_documents(documents: list[bytes], net: Network, tables: np.ndarray) -> np.ndarray:
    """Sum of the log-probabilities of all tokens of each document."""
    at, lengths, row = windows(documents)
    logs = np.zeros(len(at) + 1)
    for i in range(0, len(at), _TOKENS):
        part = at[i:i + _TOKENS]
        logs[i:i + len(part)] = net.log_probabilities(sides(row, part), row[part], tables)
    total = np.concatenate([[0], np.cumsum(logs[:-1])])
    ends = np.cumsum(lengths)
    return total[ends] - total[ends - lengths]


def score(encoded: DataFrame, net: Network) -> DataFrame:
    model = encoded.sparkSession.sparkContext.broadcast(net)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = model.value.position_tables()
        for batch in batches:
            keys, documents = batch.column(0), batch.column(1).to_pylist()
            rows = batch.column(2)
            for a, b in groups_by_bytes(documents):
                counts = np.fromiter(map(len, documents[a:b]), np.int64, b - a)
                sums = score_documents(documents[a:b], model.value, tables)
                yield pa.RecordBatch.from_arrays([keys.slice(a, b - a), rows.slice(a, b - a), pa.array(counts), pa.array(sums)],
                                                 names=["doc_id", "row", "n_tokens", "log_likelihood"])

    scored = map_batches(encoded.select("doc_id", "tokens", "row"), run, "doc_id long, row long, n_tokens long, log_likelihood double")
    mean = F.when(F.col("n_tokens") > 0, F.col("log_likelihood") / F.col("n_tokens"))
    return scored.withColumn("mean_log_likelihood", mean)


def with_words(scored: DataFrame, encoded: DataFrame, logs: DataFrame) -> DataFrame:
    """Adds ``word_log_likelihood``: the class probabilities times P(word | class) of every word."""
    rest = encoded.select("row", F.explode("rest").alias("r")).select("row", "r.*").join(logs, "name", "left")
    sums = rest.groupBy("row").agg(F.sum(F.col("n") * F.coalesce("log", "unseen")).alias("rest_log"))
    words = encoded.select("row", "known_log").join(sums, "row", "left").select("row", (F.col("known_log") + F.coalesce("rest_log", F.lit(0.0))).alias("word_log"))
    whole = scored.join(words, "row").withColumn("word_log_likelihood", F.col("log_likelihood") + F.col("word_log"))
    mean = F.when(F.col("n_tokens") > 0, F.col("word_log_likelihood") / F.col("n_tokens"))
    return whole.withColumn("mean_word_log_likelihood", mean).drop("row", "word_log")


def pseudo_likelihood(docs: DataFrame, rounds: int = ROUNDS, every: int = EVERY) -> DataFrame:
    """(doc_id, n_tokens, log_likelihood, mean_log_likelihood, word_log_likelihood, mean_word_log_likelihood) of every document, by a network trained on
    the same documents. The result depends on the documents alone, not on how they are dealt over files, tasks or cores.

    Words of all texts are counted; the ``FREQUENT`` most frequent are tokens of their own, the rest share tokens by their endings. Every token of a
    document is predicted from ``SIDE`` tokens on either side, and the logarithms of the probabilities are added: of the tokens alone in
    ``log_likelihood``, of the words themselves (token, and word given token by the counts of all words) in ``word_log_likelihood``. A null or empty text has no
    tokens, sum 0 and a null mean. Repeated rows get equal scores. Extra columns are left out; an empty table gives no rows.
    """
    counts = stored(word_counts(docs), "word-counts")
    top = [(bytes(r.word), r.n) for r in counts.orderBy(F.desc("n"), "word").limit(KNOWN).collect()]
    frequent = [w for w, _ in top[:FREQUENT]]
    totals, classes = class_totals(counts, frequent), Classes(frequent)
    known = {w: float(np.log(n / (totals[classes[w]] + 1))) for w, n in top[FREQUENT:]}
    rows = stored(encode(docs, frequent, known, totals).withColumn("row", F.monotonically_increasing_id()), "tokens")
    return with_words(score(rows, train(rows, rounds, every)), rows, word_logs(counts, frequent, totals))


def op7_pseudo_likelihood(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudo_likelihood(table(spark, sf_dir, "documents"))
