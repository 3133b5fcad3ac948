"""Groups of spelling variants: words one edit apart, found by walking a distributed trie level by level.

There is a trie for each length of words and each reading direction, as an edge table: (node, label, child), a node for each prefix. States are (word,
position, node, edits). A word reaches the nodes of its own prefixes without an edit. There it makes its one edit: it follows an edge of another
letter (replaced), or leaves out its letter in the trie of words that are shorter by one (deleted; an inserted letter is the same seen from the
other word). From then on it may only follow edges of its own letters, and a state that is at the end of a word has found a neighbour.

An edit in the second half of a word is made in the forward trie and one in the first half in the trie of reversed words, so the
nodes where states part lie deep, where few words share one. Behind its edit a state goes on in strides: a node with r letters below it has
edges of as many letters as the highest power of two in r, so a walk takes as many rounds as r has binary ones.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pageprism.llm.common import column_bytes, groups_by_bytes, map_batches, table
from pageprism.session import stored

LEAST_LENGTH = 5
LEAST_COUNT = 3
FORM_RATIO = 2
DELETED_IN = 97
MOST_WORDS = 500_000
#: Longer runs (in bytes) take their checksum one by one.
SHORT_RUN = 48
ROWS = 1 << 16

_RUN = re.compile(rb"(?:[a-z]+|(?:\xc3[\x80-\xbf])+)+")
_OTHER = re.compile(rb"[\xc2\xc4-\xff]")
#: A-Z to small letters, all other bytes of ASCII to blanks, but for letters.
_LETTERS = bytes(b | 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b > 127 else 32 for b in range(256))

_FACTOR = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_FACTOR, -1, 1 << 64)


def runs(text: bytes) -> list[bytes]:
    """Maximal runs of letters A-Z, a-z and U+00C0 to U+00FF, with A-Z folded."""
    folded = text.translate(_LETTERS)
    return _RUN.findall(folded) if _OTHER.search(folded) else folded.split()


class _Seen(dict):
    """Number of each run; new runs are noted."""

    def __init__(self):
        super().__init__()
        self.fresh: list[bytes] = []

    def __missing__(self, run: bytes) -> int:
        self.fresh.append(run)
        n = self[run] = len(self)
        return n


class _Counts:
    """Counts of runs and of runs that have lost a letter.

    The checksum of prefix + run is that of the prefix followed by zeros, xor a number of the run alone; so it takes one
    look-up per run and one per document and length.
    """

    def __init__(self):
        self.seen, self.counts = _Seen(), np.zeros(0, np.int64)
        self.own = np.zeros(0, np.int64)
        self.length = np.zeros(0, np.int64)
        self.points = np.zeros(0, np.int64)
        self.lost: Counter = Counter()

    def add(self, prefixes: list[bytes], texts: list[bytes]) -> None:
        found = [runs(t) for t in texts]
        words = [w for own in found for w in own]
        at = np.fromiter(map(self.seen.__getitem__, words), np.int64, len(words))
        doc = np.repeat(np.arange(len(found)), [len(own) for own in found])
        self._learn()
        checks = np.zeros((len(texts), SHORT_RUN + 1), np.int64)
        starts = [zlib.crc32(p) for p in prefixes]
        lengths = self.length[at]
        for n in np.unique(lengths[lengths <= SHORT_RUN]).tolist():
            checks[:, n] = [zlib.crc32(bytes(n), s) for s in starts]
        hashes = checks[doc, np.minimum(lengths, SHORT_RUN)] ^ self.own[at]
        for i in np.nonzero(lengths > SHORT_RUN)[0].tolist():
            hashes[i] = zlib.crc32(words[i], starts[doc[i]])
        hit = hashes % DELETED_IN == 0
        self.counts += np.bincount(at[~hit], minlength=len(self.counts))
        hashes, at = hashes[hit], at[hit]
        places, times = np.unique(np.stack([at, hashes % self.points[at]], 1), axis=0, return_counts=True)
        names = list(self.seen) if len(places) else []
        for (run, place), n in zip(places.tolist(), times.tolist()):
            word = names[run].decode()
            self.lost[(word[:place] + word[place + 1:]).encode()] += n

    def _learn(self) -> None:
        fresh, self.seen.fresh = self.seen.fresh, []
        more = lambda old, new: np.concatenate([old, np.array(new, np.int64)])
        self.own = more(self.own, [zlib.crc32(w) ^ zlib.crc32(bytes(len(w))) if len(w) <= SHORT_RUN else 0 for w in fresh])
        self.length = more(self.length, [len(w) for w in fresh])
        self.points = more(self.points, [len(w) - w.count(b"\xc3") for w in fresh])
        self.counts = more(self.counts, [0] * len(fresh))

    def rows(self, least_length: int) -> Iterator[pa.RecordBatch]:
        for w, n in zip(self.seen, self.counts.tolist()):
            self.lost[w] += n
        words = [w for w, n in self.lost.items() if n and len(w) - w.count(b"\xc3") >= least_length]
        for i in range(0, len(words), ROWS):
            part = words[i:i + ROWS]
            yield pa.RecordBatch.from_arrays([pa.array([w.decode() for w in part], pa.string()), pa.array([self.lost[w] for w in part], pa.int64())],
                                             names=["word", "n"])


def word_counts(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """(word, n): runs of letters of all whole texts, those whose checksum with the doc_id a fixed number divides without one
    letter; those of ``least_length`` letters and ``least_count`` occurrences."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _Counts()
        for batch in batches:
            prefixes, texts = [b"%s:" % k for k in column_bytes(batch.column(0))], column_bytes(batch.column(1))
            for a, b in groups_by_bytes(texts):
                held.add(prefixes[a:b], texts[a:b])
                if len(held.seen) > MOST_WORDS:
                    yield from held.rows(least_length)
                    held = _Counts()
        yield from held.rows(least_length)

    rows = docs.select(F.col("doc_id").cast("long").cast("string"), F.col("text").cast("string"))
    counted = map_batches(rows, run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counted.where(F.col("n") >= least_count)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(factor: int, n: int) -> np.ndarray:
    return np.concatenate([[np.uint64(1)], np.full(n, factor, np.uint64)]).cumprod(dtype=np.uint64)


def stride(below: int) -> int:
    """Letters of an edge at a node with ``below`` letters below it."""
    return 1 << (below.bit_length() - 1)


class Words:
    """Words of one length in both directions, as hashes of their prefixes. 64-bit hashes of different prefixes or labels may be
    equal; pairs of words are compared in the end."""

    def __init__(self, words: list[str], ids: np.ndarray):
        self.n, self.size, self.ids = len(words), len(words[0]), ids
        points = np.frombuffer("".join(words).encode("utf-32-le"), "<u4").reshape(self.n, self.size).astype(np.uint64)
        self.sides = []
        for letters in (points, points[:, ::-1]):
            sums = np.cumsum(_mixed(letters + np.uint64(0x51ED27)) * _powers(_FACTOR, self.size - 1), 1, dtype=np.uint64)
            self.sides.append((letters, np.concatenate([np.zeros((self.n, 1), np.uint64), sums], 1)))
        self.back = _powers(_INVERSE, self.size)

    def node(self, side: int, length: int, depth: int) -> np.ndarray:
        """Nodes of the prefixes of ``depth`` letters in the trie of words of ``length`` letters."""
        salt = _mixed(np.array([(length * 2 + side) << 32 | depth], np.uint64))
        return _mixed(self.sides[side][1][:, depth] ^ salt).view(np.int64)

    def label(self, side: int, start: int, length: int) -> np.ndarray:
        sums = self.sides[side][1]
        return _mixed((sums[:, start + length] - sums[:, start]) * self.back[start] + np.uint64(length)).view(np.int64)

    def walk(self, side: int, start: int) -> np.ndarray:
        """Labels that a state follows from its letter ``start`` on."""
        labels, below = [], self.size - start
        while below:
            labels.append(self.label(side, start, stride(below)))
            start, below = start + stride(below), below - stride(below)
        return np.stack(labels, 1) if labels else np.zeros((self.n, 0), np.int64)

    def half(self, side: int) -> int:
        """First letter in reading direction whose edits are made on this side."""
        return self.size // 2 if side == 0 else self.size - self.size // 2

    def letter_edges(self):
        """(node, letter, child) at which a letter may be replaced."""
        for side in (0, 1):
            for p in range(self.half(side), self.size):
                yield self.node(side, self.size, p), self.sides[side][0][:, p].astype(np.int32), self.node(side, self.size, p + 1)

    def stride_edges(self):
        """(node, label, child) behind an edit."""
        for side in (0, 1):
            for p in range((self.size + 1) // 2, self.size):
                s = stride(self.size - p)
                yield self.node(side, self.size, p), self.label(side, p, s), self.node(side, self.size, p + s)

    def unedited(self):
        """(word, position, node, letter there, labels behind it): states without an edit."""
        for side in (0, 1):
            for p in range(self.half(side), self.size):
                yield self.ids, p, self.node(side, self.size, p), self.sides[side][0][:, p].astype(np.int32), self.walk(side, p + 1)

    def deleted(self):
        """(word, position, node, labels): states whose letter before the position is left out, in the trie of shorter words."""
        for side in (0, 1):
            for p in range(self.half(side), self.size):
                yield self.ids, p + 1, self.node(side, self.size - 1, p), self.walk(side, p + 1)

    def ends(self):
        """(node, word) of whole words."""
        for side in (0, 1):
            yield self.node(side, self.size, self.size), self.ids


def _by_length(words: DataFrame, make, schema: str) -> DataFrame:
    """Rows that ``make`` yields, as arrays, for the words of each length in a batch."""
    kinds = [(f.split()[0], {"int": pa.int32(), "long": pa.int64(), "array<long>": pa.list_(pa.int64())}[f.split()[1]]) for f in schema.split(", ")]

    def column(x, kind, n):
        if kind == pa.list_(pa.int64()):
            return pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * x.shape[1]), pa.array(np.ascontiguousarray(x).ravel()))
        return pa.array(np.full(n, x, np.int32) if isinstance(x, int) else x, kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, ids = np.array(batch.column(1).to_pylist(), object), batch.column(0).to_numpy()
            lengths = np.fromiter(map(len, texts), np.int64, len(texts))
            for size in np.unique(lengths).tolist():
                own = np.nonzero(lengths == size)[0]
                step = max(1, ROWS // size)
                for i in range(0, len(own), step):
                    part = own[i:i + step]
                    for values in make(Words(texts[part].tolist(), ids[part])):
                        yield pa.RecordBatch.from_arrays([column(x, kind, len(part)) for x, (_, kind) in zip(values, kinds)], names=[k for k, _ in kinds])

    return map_batches(words.select("id", "word"), run, schema)


def neighbours(words: DataFrame, least_length: int = LEAST_LENGTH) -> DataFrame:
    """(word, near) in both directions: all pairs of ``word`` (distinct, not null) that differ by exactly one inserted, deleted or replaced
    code point. Words shorter than ``least_length`` must not be among them."""
    words = stored(words.select(F.xxhash64("word").alias("id"), "word"), "trie-words")
    letters = _by_length(words, Words.letter_edges, "node long, letter int, child long").repartition("node").dropDuplicates(["node", "letter"])
    edges = stored(_by_length(words, Words.stride_edges, "node long, label long, child long").dropDuplicates(["node", "label"]), "trie-edges")
    unedited = _by_length(words, Words.unedited, "id long, position int, node long, own int, labels array<long>")
    replaced = unedited.join(letters, "node").where(F.col("letter") > F.col("own")).select(
        "id", (F.col("position") + 1).alias("position"), F.col("child").alias("node"), "labels")
    deleted = _by_length(words.where(F.length("word") > least_length), Words.deleted, "id long, position int, node long, labels array<long>")
    states = stored(replaced.union(deleted).withColumn("edits", F.lit(1)), "trie-states")
    level, at_end = 0, []
    while not states.isEmpty():
        at_end.append(states.where(F.size("labels") == level).select("id", "node"))
        going = states.where(F.size("labels") > level).withColumn("label", F.element_at("labels", level + 1))
        states = stored(going.join(edges, ["node", "label"]).select("id", "position", F.col("child").alias("node"), "labels", "edits"), "trie-states")
        level += 1
    ends = _by_length(words, Words.ends, "node long, near long")
    found = None
    for part in at_end:
        found = part if found is None else found.union(part)
    if found is None:
        return words.select("word", F.col("word").alias("near")).limit(0)
    pairs = found.join(ends, "node").select("id", "near").distinct()
    named = pairs.join(words, "id").join(words.select(F.col("id").alias("near"), F.col("word").alias("other")), "near")
    named = named.where(F.levenshtein("word", "other", 1) == 1)
    return named.select("word", F.col("other").alias("near")).union(named.select(F.col("other").alias("word"), F.col("word").alias("near"))).distinct()


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of (word, form): the last word that following forms reaches. Pointers are doubled, so rounds grow with the logarithm of
    the longest chain, which is itself logarithmic in the greatest count."""
    steps = stored(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        on = steps.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        longer = stored(steps.join(on, "root", "left").select("word", F.coalesce("beyond", "root").alias("root"), F.col("beyond").isNotNull().alias("moved")), "roots")
        steps = longer.select("word", "root")
        if longer.where("moved").isEmpty():
            return steps


def variant_groups(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, ratio: int = FORM_RATIO) -> DataFrame:
    """word, n, n_near, form, form_n, root of every word of ``docs`` (doc_id, text).

    A null or empty text has no words; a null doc_id counts as an empty one in the checksum; repeated rows count each;
    other columns are left out; an empty table gives no rows.
    """
    words = stored(word_counts(docs, least_length, least_count), "words")
    near = stored(neighbours(words, least_length), "neighbours")
    counts = words.select(F.col("word").alias("near"), F.col("n").alias("near_n"))
    best = near.join(counts, "near").groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("near"))).alias("first"))
    known = words.join(best, "word", "left")
    has_form = -F.col("first.less") >= F.col("n") * ratio
    known = stored(known.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(has_form, F.col("first.near")).alias("form"),
                                F.when(has_form, -F.col("first.less")).alias("form_n")), "forms")
    ends = roots(known.where("form IS NOT NULL"))
    return known.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variant_groups(table(spark, sf_dir, "documents"))
