"""Near-duplicates by SimHash fingerprints and an inverted index over the positions of their bytes."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pageprism.llm.common import column_bytes, map_batches, table
from pageprism.llm.components import components
from pageprism.session import stored

SHINGLE_WORDS = 3
SEED = 42
BITS_APART = 2
BYTES = 8
LONG_POSTING = 64
_CHUNK = 1 << 16


def shingle_hashes(text: bytes, n: int, seed: int = SEED) -> np.ndarray:
    """XXH64 of each shingle of ``n`` words, repeats included. Words are runs without ASCII blanks after folding A-Z; fewer words
    than ``n`` make one shingle, none make none."""
    from xxhash import xxh64_intdigest

    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    shingles = [b" ".join(words)] if len(words) < n else map(b" ".join, zip(*(words[i:] for i in range(n))))
    return np.fromiter(map(xxh64_intdigest, shingles, repeat(seed)), np.uint64)


def fingerprint(hashes: np.ndarray) -> int:
    """Bit k is 1 if it is set in more than half the hashes."""
    votes = np.zeros(64, np.int64)
    for i in range(0, len(hashes), _CHUNK):
        part = hashes[i:i + _CHUNK].astype("<u8").view(np.uint8).reshape(-1, 8)
        votes += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = (2 * votes > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def with_fingerprints(docs: DataFrame, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """doc_id, ``mark`` (hash of the text, which tells rows of one doc_id apart) and ``fp`` (the fingerprint's 64 bits as a signed long)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [fingerprint(shingle_hashes(text, shingle_words)) for text in column_bytes(batch.column(2))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(np.array(prints, np.uint64).view(np.int64))],
                                             names=["doc_id", "mark", "fp"])

    return map_batches(docs.select(F.col("doc_id").cast("long"), text_mark().alias("mark"), F.col("text").cast("string")), run,
                       "doc_id long, mark long, fp long")


def text_mark() -> Column:
    """Hash of a text; that of null differs from that of the empty text."""
    text = F.col("text").cast("string")
    return F.xxhash64(text, text.isNull())


def _byte(fp: Column, position: int) -> Column:
    return F.shiftrightunsigned(fp, 8 * position).bitwiseAND(F.lit(255))


def postings(prints: DataFrame, bits_apart: int = BITS_APART) -> DataFrame:
    """Inverted index over positional bytes: (positions, bytes, fp).

    Prints at most ``bits_apart`` bits apart differ in at most as many bytes, so they share ``BYTES - bits_apart`` positional bytes at least.
    A list per single byte would hold 1/256 of all prints, and tallying it would meet about all pairs. So lists are
    kept per set of bytes: the 8 positions form blocks, and the lists are of all but ``bits_apart`` of ``bits_apart + 2`` blocks:
    whichever bytes differ, two blocks stay whole.
    """
    blocks = [list(map(int, b)) for b in np.array_split(np.arange(BYTES), bits_apart + 2)]
    keys = []
    for number, chosen in enumerate(combinations(blocks, 2)):
        value = reduce(lambda x, p: F.shiftleft(x, 8).bitwiseOR(_byte(F.col("fp"), p)), sum(chosen, []), F.lit(0).cast("long"))
        keys.append(F.struct(F.lit(number).alias("positions"), value.alias("bytes")))
    return prints.select("fp", F.explode(F.array(*keys)).alias("k")).select("k.positions", "k.bytes", "fp")


def shared_bytes(a: Column, b: Column) -> Column:
    """Tally of the positional bytes that two prints share."""
    return reduce(lambda x, y: x + y, [(_byte(a, p) == _byte(b, p)).cast("int") for p in range(BYTES)])


def links(prints: DataFrame, bits_apart: int = BITS_APART, long_posting: int = LONG_POSTING) -> DataFrame:
    """Links (a, b) whose connected components are those of all pairs of ``prints`` (distinct ``fp``) at most ``bits_apart`` bits apart.

    Pairs of a posting list are tallied by shared positional bytes; those with the guaranteed minimum are verified bit by
    bit. A list longer than ``long_posting`` isn't expanded into pairs. Its prints name every value within ``bits_apart / 2`` bits of
    themselves, and prints that name the same value are linked to the least of them: two prints are at most an even number of bits
    apart exactly if they name a value in common. That is exact and makes as many rows as prints, whatever the list's length.
    """
    if bits_apart % 2:
        raise ValueError("bits_apart must be even")
    index = stored(postings(prints, bits_apart), "postings")
    sizes = index.groupBy("positions", "bytes").agg(F.count(F.lit(1)).alias("n"))
    short = index.join(sizes.where(F.col("n").between(2, long_posting)), ["positions", "bytes"]).drop("n")
    a, b = F.col("a"), F.col("b")
    pairs = short.withColumnRenamed("fp", "a").join(short.withColumnRenamed("fp", "b"), ["positions", "bytes"]).where(a < b)
    near = pairs.where(shared_bytes(a, b) >= BYTES - bits_apart).where(F.bit_count(a.bitwiseXOR(b)) <= bits_apart)
    long = index.join(sizes.where(F.col("n") > long_posting), ["positions", "bytes"], "left_semi").select("fp").distinct()
    flips = [sum(1 << k if k < 63 else -(1 << 63) for k in bits)
             for size in range(bits_apart // 2 + 1) for bits in combinations(range(64), size)]
    named = long.select("fp", F.explode(F.array(*[F.col("fp").bitwiseXOR(F.lit(m).cast("long")) for m in flips])).alias("v"))
    least = named.groupBy("v").agg(F.min("fp").alias("a"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    starred = named.join(least, "v").select("a", F.col("fp").alias("b")).where(a < b)
    return near.select("a", "b").union(starred).distinct()


def _groups(prints: DataFrame, bits_apart: int) -> DataFrame:
    """(fp, component, component_id) of every fingerprint: its component's least fingerprint and least doc_id. Equal prints are folded into one
    before the index is made, so copies cost nothing."""
    least = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "least")
    found = components(links(least.select("fp"), bits_apart))
    named = least.join(found.withColumnRenamed("node", "fp"), "fp")
    groups = named.groupBy("component").agg(F.min("least").alias("group_least"))
    linked = named.join(groups, "component").select("fp", "component", "group_least")
    return least.join(linked, "fp", "left").select("fp", F.coalesce("component", "fp").alias("component"),
                                                   F.coalesce("group_least", "least").alias("component_id"))


def near_duplicates(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, bits_apart: int = BITS_APART) -> DataFrame:
    """(doc_id, fp, component_id) of every document: the smallest doc_id that a chain of links reaches.

    Texts are linked if their fingerprints are at most ``bits_apart`` bits apart. A text without words (null, empty) has print 0. A null
    doc_id takes part in links but never names a component; a component of such rows alone has a null name. Repeated rows
    stay. Extra columns are left out.
    """
    prints = stored(with_fingerprints(docs, shingle_words), "prints")
    return prints.join(_groups(prints, bits_apart).select("fp", "component_id"), "fp").select("doc_id", "fp", "component_id")


def drop_near_duplicates(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, bits_apart: int = BITS_APART) -> DataFrame:
    """One row of each group of linked texts, all columns kept: that of the smallest doc_id, of the smallest hash of its text among rows
    of one doc_id; null doc_ids come last. A row is known by doc_id and text: rows that agree in both are one document, and of them the one with the least
    other columns (by hash) stays. Different texts of one doc_id are only dropped if they are linked. An empty table gives no rows.
    """
    prints = stored(with_fingerprints(docs, shingle_words), "prints")
    groups = _groups(prints, bits_apart).select("fp", "component")
    named = [F.col("doc_id").isNull().alias("_simhash_unnamed"), F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("_simhash_id")]
    keys = ["_simhash_unnamed", "_simhash_id", "_simhash_mark"]
    rows = prints.select("fp", *named, F.col("mark").alias("_simhash_mark"))
    first = rows.join(groups, "fp").groupBy("component").agg(F.min(F.struct(*keys)).alias("k")).select("k.*")
    copies = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_simhash_copies"))
    chosen = stored(first.join(copies, keys), "chosen")
    given = [F.col(c) for c in docs.columns]
    marked = docs.select(*given, *named, text_mark().alias("_simhash_mark"))
    kept = marked.join(chosen.where("_simhash_copies = 1").select(*keys), keys).select(*given)
    several = chosen.where("_simhash_copies > 1").select(*keys)
    if several.isEmpty():
        return kept
    rest = F.xxhash64(*[F.col(c) for c in docs.columns if c != "text"], F.lit(0)).alias("_rest")
    least = marked.join(several, keys).groupBy(*keys).agg(F.min(F.struct(rest, *given)).alias("_r"))
    return kept.union(least.select(*[F.col("_r")[c].alias(c) for c in docs.columns]))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
