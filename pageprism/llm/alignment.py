"""Alignment of the tokens that two tokenizers give the same text, and how many documents link each pair of ids.

Byte offsets at which tokens of both end cut the tokens into groups; all tokens of a group are linked. Most groups are one token of A and the one
token of B that has the same bytes. An array that holds that B id for each A id makes such a link a single number: it is counted in vectors of
the vocabulary's length. Only links of other groups are counted as pairs, by a shuffle.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pageprism.llm.common import column_bytes, groups_by_bytes, map_batches, spread_ranges, table
from pageprism.llm.tokens import tokenizer_text
from pageprism.session import stored

#: Pairs in more than one of so many links are as many at most, and are sent to all tasks.
HEAVY = 200_000
#: Groups with more links are counted by their different ids.
WIDE_GROUP = 1 << 12
HELD_KEYS = 1 << 21
_BITS = 20
_MASK = (1 << _BITS) - 1
#: Beyond U+02FF the two libraries' tables of letters may differ.
_BEYOND = re.compile(rb"[\xcc-\xff]")

_DOCS = ("id long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, same binary, odd binary")


def byte_letters() -> dict[str, int]:
    """Bytes by the characters that stand for them in byte-level vocabularies: printable Latin-1 as itself, the others from U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printable]
    return {chr(c): b for c, b in zip(printable + list(range(0x100, 0x100 + len(others))), printable + others)}


class Coders:
    """Both tokenizers, the bytes of their tokens, and for each A id the B id of the same bytes (-1 if there is none)."""

    def __init__(self, a_json: str, b_model: bytes):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(a_json)
        self.a.encode_special_tokens = True
        letters = byte_letters()
        special = {t.content for t in self.a.get_added_tokens_decoder().values()}
        self.a_bytes = [b""] * self.a.get_vocab_size()
        for token, i in self.a.get_vocab().items():
            self.a_bytes[i] = token.encode() if token in special else bytes(letters[c] for c in token)
        self.fast = self._ranked(json.loads(a_json))
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_model)
        self.b_bytes = [self._piece(i) for i in range(self.b.get_piece_size())]
        by_bytes = {}
        for i, value in enumerate(self.b_bytes):
            by_bytes.setdefault(value, i)
        self.same = np.array([by_bytes.get(v, -1) if v else -1 for v in self.a_bytes], np.int64)
        self.a_size, self.b_size = (np.array([len(x) for x in values], np.int64) for values in (self.a_bytes, self.b_bytes))
        n = max(len(self.a_bytes), len(self.b_bytes))
        self.shown = [f"{i}{mark}" for mark in (",", "|", ";", "") for i in range(n)]
        self.n_shown = n

    def _piece(self, i: int) -> bytes:
        if self.b.is_byte(i):
            return bytes([int(self.b.id_to_piece(i)[3:5], 16)])
        return self.b.id_to_piece(i).replace("▁", " ").encode()

    def _ranked(self, file: dict):
        """The same encoder by ranks, which is several times as fast; None unless ids are in the order of merges and text is split as byte-level
        vocabularies do."""
        merges = [m.split(" ") if isinstance(m, str) else m for m in file["model"]["merges"]]
        vocabulary, split = file["model"]["vocab"], file.get("pre_tokenizer") or {}
        products = [vocabulary.get(x + y, -1) for x, y in merges]
        if (file.get("normalizer") or split.get("type") != "ByteLevel" or split.get("add_prefix_space") or not split.get("use_regex", True)
                or file["model"].get("ignore_merges") or file["model"].get("dropout") or products != sorted(set(products)) or -1 in products):
            return None
        import public_tokenizers
        import tiktoken

        letters = byte_letters()
        added = {t["content"] for t in file["added_tokens"]}
        ranks = {bytes(letters[c] for c in token): i for token, i in vocabulary.items() if token not in added}
        if len(ranks) != 256 + len(products) or min(products, default=256) < 256:
            return None
        return tiktoken.Encoding("a", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode_a(self, texts: list[bytes]) -> list[list[int]]:
        found = [self.fast.encode_ordinary(t.decode()) if self.fast and not _BEYOND.search(t) else None for t in texts]
        rest = [i for i, f in enumerate(found) if f is None]
        if rest:
            made = self.a.encode_batch_fast([texts[i].decode("utf-8", "replace") for i in rest], add_special_tokens=False)
            for i, m in zip(rest, made):
                found[i] = m.ids
        return found

    def encode_b(self, texts: list[bytes]) -> list[list[int]]:
        return self.b.encode([t.decode("utf-8", "replace") for t in texts], num_threads=1)


@lru_cache(maxsize=1)
def _coders(a_json: str, b_model: bytes) -> Coders:
    return Coders(a_json, b_model)


def _flat(rows: list[list[int]]) -> np.ndarray:
    return np.fromiter(chain.from_iterable(rows), np.int64, sum(map(len, rows)))


def _sums(keys: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different keys in order, and the sum of the weights of each."""
    if not len(keys):
        return keys, weights
    order = np.argsort(keys, kind="stable")
    keys, weights = keys[order], weights[order]
    first = np.nonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))[0]
    return keys[first], np.add.reduceat(weights, first)


class Aligned:
    """Groups and links of several documents whose tokens of A and B have the same bytes."""

    def __init__(self, coders: Coders, a_rows: list[list[int]], b_rows: list[list[int]]):
        n = len(a_rows)
        a, b = _flat(a_rows), _flat(b_rows)
        a_end, b_end = np.cumsum(coders.a_size[a]), np.cumsum(coders.b_size[b])
        a_cut = b_end[np.searchsorted(b_end, a_end)] == a_end
        b_cut = a_end[np.searchsorted(a_end, b_end)] == b_end
        a_group, b_group = np.cumsum(a_cut) - a_cut, np.cumsum(b_cut) - b_cut
        groups = int(a_cut.sum())
        na, nb = np.bincount(a_group, minlength=groups), np.bincount(b_group, minlength=groups)
        a_doc, b_doc = np.repeat(np.arange(n), [len(r) for r in a_rows]), np.repeat(np.arange(n), [len(r) for r in b_rows])
        doc = a_doc[a_cut]
        self.n_groups = np.bincount(doc, minlength=n)
        self.n_links = np.zeros(n, np.int64)
        np.add.at(self.n_links, doc, na * nb)
        self.shown = self._shown(coders, n, (a, a_cut, a_group, a_doc), (b, b_cut, b_group, b_doc))
        a_first, b_first = np.cumsum(na) - na, np.cumsum(nb) - nb
        alone = (na == 1) & (nb == 1)
        alone[alone] = coders.same[a[a_first[alone]]] == b[b_first[alone]]
        same_keys = (doc[alone] << _BITS) | a[a_first[alone]]
        odd = self._odd_links(a, b, na, nb, a_first, b_first, doc, np.nonzero(~alone)[0])
        keys, times = _sums(*odd)
        linked_a, linked_b = keys >> _BITS & _MASK, keys & _MASK
        same = coders.same[linked_a] == linked_b
        folded = _sums(np.concatenate([same_keys, keys[same] >> _BITS]), np.concatenate([np.ones(len(same_keys), np.int64), times[same]]))
        self.same = self._per_doc(n, folded[0] >> _BITS, folded[0] & _MASK, folded[1])
        keys, times = keys[~same], times[~same]
        self.odd = self._per_doc(n, keys >> 2 * _BITS, keys >> _BITS & _MASK, keys & _MASK, times)

    @staticmethod
    def _odd_links(a, b, na, nb, a_first, b_first, doc, groups) -> tuple[np.ndarray, np.ndarray]:
        """(document, A id, B id) keys of the links of groups, and how often each is linked."""
        wide = na[groups] * nb[groups] > WIDE_GROUP
        keys, times = [], []
        for g in groups[wide].tolist():
            (x, nx), (y, ny) = (np.unique(ids[first[g]:first[g] + size[g]], return_counts=True)
                                for ids, first, size in ((a, a_first, na), (b, b_first, nb)))
            keys.append(((doc[g] << 2 * _BITS) | (x[:, None] << _BITS) | y[None, :]).ravel())
            times.append((nx[:, None] * ny[None, :]).ravel())
        narrow = groups[~wide]
        at = spread_ranges(a_first[narrow], na[narrow])
        group = np.repeat(narrow, na[narrow])
        partner = spread_ranges(b_first[group], nb[group])
        at, group = np.repeat(at, nb[group]), np.repeat(group, nb[group])
        keys.append((doc[group] << 2 * _BITS) | (a[at] << _BITS) | b[partner])
        times.append(np.ones(len(at), np.int64))
        return np.concatenate(keys), np.concatenate(times)

    @staticmethod
    def _per_doc(n: int, doc: np.ndarray, *columns: np.ndarray) -> list[bytes]:
        """Rows of unsigned 32-bit integers of each document; ``doc`` is in order. Times beyond 32 bits are kept in two parts."""
        rows = np.stack([c.astype(np.uint64) for c in (*columns[:-1], columns[-1] & 0xFFFFFFFF, columns[-1] >> 32)], 1).astype("<u4")
        ends = np.searchsorted(doc, np.arange(n + 1))
        return [rows[x:y].tobytes() for x, y in zip(ends[:-1], ends[1:])]

    @staticmethod
    def _shown(coders: Coders, n: int, a, b) -> list[str]:
        """`a1,a2|b1;a3|b2,b3` of each document: A ids of each group, then its B ids."""
        (a, a_cut, a_group, a_doc), (b, b_cut, b_group, b_doc) = a, b
        place_a = np.arange(len(a)) + np.searchsorted(b_group, a_group)  # B tokens of earlier groups go before
        place_b = np.arange(len(b)) + np.searchsorted(a_group, b_group, "right")
        text = np.zeros(len(a) + len(b), np.int64)
        text[place_a] = a + coders.n_shown * np.where(a_cut, 1, 0)
        text[place_b] = b + coders.n_shown * np.where(b_cut, 2, 0)
        ends = np.bincount(a_doc, minlength=n) + np.bincount(b_doc, minlength=n)
        ends = np.cumsum(ends)
        text[ends - 1] += coders.n_shown  # no mark behind the last group
        parts = list(map(coders.shown.__getitem__, text.tolist()))
        return ["".join(parts[x:y]) for x, y in zip(np.concatenate([[0], ends[:-1]]).tolist(), ends.tolist())]


def _joined(rows: list[list[int]], values: list[bytes], texts: list[bytes]) -> list[bool]:
    return [b"".join(map(values.__getitem__, ids)) == text for ids, text in zip(rows, texts)]


def align(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """One row per document: id (of the row), doc_id, n_a, n_b, n_groups, n_links, groups_sha256, and the document's links: ``same`` holds
    (A id, times) of links to the B id of the same bytes, ``odd`` (A id, B id, times) of all others."""
    spark = docs.sparkSession
    with open(b_path, "rb") as f:
        files = spark.sparkContext.broadcast((tokenizer_text(a_path), f.read()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context, made, coders = TaskContext.get(), 0, _coders(*files.value)
        first = (context.partitionId() if context else 0) << 33
        for batch in batches:
            keys, texts = batch.column(0), column_bytes(batch.column(1))
            for lo, hi in groups_by_bytes(texts, 1 << 20):
                spaced = [b" " + t for t in texts[lo:hi]]
                some = [i for i, t in enumerate(texts[lo:hi]) if t]
                a_rows, b_rows = coders.encode_a([spaced[i] for i in some]), coders.encode_b([texts[lo + i] for i in some])
                wanted = [spaced[i] for i in some]
                good = [x and y for x, y in zip(_joined(a_rows, coders.a_bytes, wanted), _joined(b_rows, coders.b_bytes, wanted))]
                a_rows, b_rows, some = ([x for x, g in zip(values, good) if g] for values in (a_rows, b_rows, some))
                found = Aligned(coders, a_rows, b_rows) if some else None
                slot = {i: k for k, i in enumerate(some)}
                at = [slot.get(i) for i in range(hi - lo)]
                take = lambda values, none: [none if k is None else values[k] for k in at]  # noqa: E731,B023
                digests = [hashlib.sha256(s.encode()).hexdigest() for s in found.shown] if found else []
                numbers = [[len(r) for r in a_rows], [len(r) for r in b_rows], *((found.n_groups.tolist(), found.n_links.tolist()) if found else ([], []))]
                yield pa.RecordBatch.from_arrays([
                    pa.array(range(first + made, first + made + hi - lo), pa.int64()), keys.slice(lo, hi - lo),
                    *[pa.array(take(x, 0), pa.int64()) for x in numbers], pa.array(take(digests, ""), pa.string()),
                    pa.array(take(found.same if found else [], b""), pa.binary()), pa.array(take(found.odd if found else [], b""), pa.binary())],
                    names=["id", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "same", "odd"])
                made += hi - lo

    return map_batches(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), run, _DOCS)


def _links(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The rows of a binary column of ``_per_doc``, their times folded into one number, and the number of rows of each document."""
    values = column.to_pylist()
    rows = np.frombuffer(b"".join(values), "<u4").reshape(-1, width).astype(np.int64)
    rows = np.concatenate([rows[:, :-2], rows[:, -2:-1] | rows[:, -1:] << 32], 1)
    return rows, np.fromiter((len(v) // (4 * width) for v in values), np.int64, len(values))


def pair_counts(aligned: DataFrame, same: np.ndarray) -> DataFrame:
    """(a, b, n): how many documents hold each linked pair of ids. Each task adds up pairs of the same bytes in one vector and folds
    the others before the shuffle."""
    given = aligned.sparkSession.sparkContext.broadcast(same)

    def rows(a, b, n) -> Iterator[pa.RecordBatch]:
        for i in range(0, len(a), 1 << 16):
            yield pa.RecordBatch.from_arrays([pa.array(x[i:i + (1 << 16)], kind) for x, kind in ((a, pa.int32()), (b, pa.int32()), (n, pa.int64()))],
                                             names=["a", "b", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vector, held = np.zeros(len(given.value), np.int64), (np.zeros(0, np.int64), np.zeros(0, np.int64))
        for batch in batches:
            vector += np.bincount(_links(batch.column(0), 3)[0][:, 0], minlength=len(vector))
            pairs = _links(batch.column(1), 4)[0]
            new = (pairs[:, 0] << _BITS) | pairs[:, 1]
            held = _sums(np.concatenate([held[0], new]), np.concatenate([held[1], np.ones(len(new), np.int64)]))
            if len(held[0]) > HELD_KEYS:
                yield from rows(held[0] >> _BITS, held[0] & _MASK, held[1])
                held = (np.zeros(0, np.int64), np.zeros(0, np.int64))
        yield from rows(held[0] >> _BITS, held[0] & _MASK, held[1])
        seen = np.nonzero(vector)[0]
        yield from rows(seen, given.value[seen], vector[seen])

    return map_batches(aligned.select("same", "odd"), run, "a int, b int, n long").groupBy("a", "b").agg(F.sum("n").alias("n"))


def _vector(rows: DataFrame, size: int) -> np.ndarray:
    """Values by A id, of at most one row per id of the vocabulary."""
    found = rows.toArrow()
    out = np.zeros(size, np.int64)
    out[found.column(0).to_numpy()] = found.column(1).to_numpy()
    return out


def scored(aligned: DataFrame, same: np.ndarray, heavy: int = HEAVY) -> DataFrame:
    """Columns of ``align`` but for the links, with n_best (links whose pair no other pair of its A id surpasses) and count_sum
    (documents of the pair, summed over links).

    Counts of pairs of the same bytes and the highest count of each A id are vectors of the vocabulary's length. Of all other pairs those in more
    than one of ``heavy`` links are sent to every task, ``heavy`` at most; only links of the rest are joined with their counts.
    """
    spark = aligned.sparkSession
    by_bytes = spark.createDataFrame(pa.table({"a": pa.array(range(len(same)), pa.int32()), "b": pa.array(same, pa.int32())}))
    counts = stored(pair_counts(aligned, same), "pair-counts")
    best = _vector(counts.groupBy("a").agg(F.max("n")), len(same))
    alike = _vector(counts.join(F.broadcast(by_bytes), ["a", "b"], "left_semi").select("a", "n"), len(same))
    odd = counts.join(F.broadcast(by_bytes), ["a", "b"], "left_anti")
    least = (odd.agg(F.sum("n")).first()[0] or 0) / heavy
    often = odd.where(F.col("n") > least).toArrow()
    keys = (often.column(0).to_numpy().astype(np.int64) << _BITS) | often.column(1).to_numpy()
    order = np.argsort(keys)
    shared = spark.sparkContext.broadcast((best, alike, keys[order], often.column(2).to_numpy()[order]))

    def known(pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Count of each pair, and whether it is a heavy one."""
        _, _, held, numbers = shared.value
        wanted = (pairs[:, 0] << _BITS) | pairs[:, 1]
        if not len(held):
            return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
        at = np.minimum(np.searchsorted(held, wanted), len(held) - 1)
        found = held[at] == wanted
        return np.where(found, numbers[at], 0), found

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, alike = shared.value[:2]
        for batch in batches:
            n_best, count_sum = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
            for column, width in ((batch.column(7), 3), (batch.column(8), 4)):
                links, sizes = _links(column, width)
                doc = np.repeat(np.arange(batch.num_rows), sizes)
                n, use = (alike[links[:, 0]], np.ones(len(links), bool)) if width == 3 else known(links)
                np.add.at(count_sum, doc, links[:, -1] * n * use)
                np.add.at(n_best, doc, links[:, -1] * (use & (n == best[links[:, 0]])))
            yield pa.RecordBatch.from_arrays([*batch.columns[:7], pa.array(n_best), pa.array(count_sum)],
                                             names=[*batch.schema.names[:7], "known_best", "known_sum"])

    def rest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            links, sizes = _links(batch.column(1), 4)
            left = ~known(links)[1]
            ids = np.repeat(batch.column(0).to_numpy(), sizes)[left]
            links = links[left]
            for i in range(0, len(ids), 1 << 16):
                part = links[i:i + (1 << 16)]
                yield pa.RecordBatch.from_arrays([pa.array(ids[i:i + (1 << 16)]), pa.array(part[:, 0], pa.int32()), pa.array(part[:, 1], pa.int32()),
                                                  pa.array(part[:, 2])], names=["id", "a", "b", "times"])

    highest = spark.createDataFrame(pa.table({"a": pa.array(range(len(best)), pa.int32()), "highest": pa.array(best)}))
    rare = odd.where(F.col("n") <= least).join(F.broadcast(highest), "a").select("a", "b", "n", (F.col("n") == F.col("highest")).alias("is_best"))
    joined = map_batches(aligned.select("id", "odd"), rest, "id long, a int, b int, times long").join(rare, ["a", "b"])
    more = joined.groupBy("id").agg(F.sum(F.col("times") * F.col("n")).alias("more_sum"),
                                    F.sum(F.when(F.col("is_best"), F.col("times")).otherwise(0)).alias("more_best"))
    names = ["id", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
    schema = _DOCS.split(", same")[0] + ", known_best long, known_sum long"
    found = map_batches(aligned.select(*names, "same", "odd"), run, schema).join(more, "id", "left")
    plus = lambda x, y: (F.col(x) + F.coalesce(y, F.lit(0))).cast("long")
    return found.select(*names[1:6], plus("known_best", "more_best").alias("n_best"), plus("known_sum", "more_sum").alias("count_sum"), "groups_sha256")


def default_paths() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def align_tokenizers(docs: DataFrame, a_path: str | None = None, b_path: str | None = None, heavy: int = HEAVY) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every document.

    A is a byte-level ``tokenizers`` file and encodes space + text, special tokens as plain text; B is a ``sentencepiece`` model that puts the space
    before itself. A text that is null or empty, or whose joined token bytes of A or B differ from space + text, has no tokens: zeros
    and an empty digest. Each row is a document of its own, repeated ones too; a null doc_id stays null; other columns are left out; an
    empty table gives no rows.
    """
    default = default_paths()
    a_path, b_path = a_path or default[0], b_path or default[1]
    aligned = stored(align(docs, a_path, b_path), "aligned")
    with open(b_path, "rb") as f:
        same = Coders(tokenizer_text(a_path), f.read()).same
    return scored(aligned, same, heavy)


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align_tokenizers(table(spark, sf_dir, "documents"))
