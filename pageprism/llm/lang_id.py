"""Language identification by the nearest of several TF-IDF centroids per language."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pageprism.llm.common import column_bytes, map_batches, spread_ranges, table
from pageprism.session import stored

FEATURES = 1 << 14
CENTROIDS = 4
SAMPLE_PER_LANGUAGE = 400
MOST_SAMPLES = 4000
MOST_LANGUAGES = 500
REJECT_QUANTILE = 0.01
REJECT_MARGIN = 0.5
FOLDS = 5
UNKNOWN = "und"
_PIECE = 1 << 20

_ALPHA = np.zeros(0, bool)


def _is_letter(points: np.ndarray) -> np.ndarray:
    global _ALPHA
    if not len(_ALPHA):
        _ALPHA = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    return _ALPHA[points]


def gram_counts(text: str) -> np.ndarray | None:
    """Counts of hashed letter bigrams and trigrams of a whole text, words set off by one blank; null without a letter. Works piece by
    piece, so memory is bounded; pieces meet at word ends."""
    counts, letters, at = np.zeros(FEATURES, np.int64), False, 0
    while at < len(text):
        end = at + _PIECE
        while end < len(text) and not text[end].isspace() and end < at + 2 * _PIECE:
            end += 1
        points = np.frombuffer(text[at:end].lower().encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
        at = end
        kept = np.where(_is_letter(points), points, 32)
        kept = np.concatenate([[32], kept, [32]])
        kept = kept[np.concatenate([[True], (kept[1:] != 32) | (kept[:-1] != 32)])]
        if len(kept) < 3:
            continue
        letters = True
        two = kept[:-1] * 0x9E3779B1 + kept[1:] * 0x85EBCA6B
        three = (two[:-1] * 31 + kept[2:] * 0xC2B2AE35)[kept[1:-1] != 32]  # none across words
        for grams in (two, three):
            counts += np.bincount(((grams ^ (grams >> 15)) & 0x7FFFFFFF) % FEATURES, minlength=FEATURES)
    return counts if letters else None


@dataclass
class Centroids:
    """Unit vectors with their languages, the features' weights, and the least similarity that each language accepts."""

    languages: list[str]
    idf: np.ndarray
    vectors: np.ndarray
    owner: np.ndarray
    least: np.ndarray

    def predict(self, text: str) -> tuple[str, float, bool]:
        """Language of the nearest centroid, cosine, and whether the text is too far from it. ``und`` without a letter or a model."""
        counts = gram_counts(text)
        if counts is None or not self.languages:
            return UNKNOWN, 0.0, True
        at = np.nonzero(counts)[0]
        cosines = self.vectors[:, at] @ unit(np.log1p(counts[at], dtype=np.float32) * self.idf[at])
        best = int(cosines.argmax())
        score = float(min(1.0, max(0.0, cosines[best])))
        language = int(self.owner[best])
        return self.languages[language], score, bool(score < self.least[language])


def unit(v: np.ndarray) -> np.ndarray:
    return v / np.maximum(np.linalg.norm(v, axis=-1, keepdims=True), 1e-12)


@dataclass
class Rows:
    """Sparse rows: the features of row i are ``at[start[i]:start[i + 1]]``, with ``value``. No row is empty."""

    start: np.ndarray
    at: np.ndarray
    value: np.ndarray

    def __len__(self) -> int:
        return len(self.start) - 1

    def of(self) -> np.ndarray:
        """Row of each entry."""
        return np.repeat(np.arange(len(self)), np.diff(self.start))

    def pick(self, rows: np.ndarray) -> Rows:
        sizes = np.diff(self.start)[rows]
        entries = spread_ranges(self.start[:-1][rows], sizes)
        return Rows(np.concatenate([[0], np.cumsum(sizes)]), self.at[entries], self.value[entries])

    def dense(self, row: int) -> np.ndarray:
        out = np.zeros(FEATURES, np.float32)
        part = slice(self.start[row], self.start[row + 1])
        out[self.at[part]] = self.value[part]
        return out

    def cosines(self, centres: np.ndarray) -> np.ndarray:
        """Products with each centre; rows and centres are of length 1."""
        return np.stack([np.add.reduceat(self.value * c[self.at], self.start[:-1]) for c in centres], 1)

    def total(self, chosen: np.ndarray) -> np.ndarray:
        keep = np.repeat(chosen, np.diff(self.start))
        return np.bincount(self.at[keep], self.value[keep], FEATURES).astype(np.float32)


def cluster(rows: Rows, k: int, seed: int, rounds: int = 12) -> np.ndarray:
    """Spherical k-means, started from rows far from those already chosen."""
    rng = np.random.default_rng(seed)
    centres = rows.dense(int(rng.integers(len(rows))))[None]
    while len(centres) < min(k, len(rows)):
        centres = np.vstack([centres, rows.dense(int(rows.cosines(centres).max(1).argmin()))[None]])
    for _ in range(rounds):
        nearest = rows.cosines(centres).argmax(1)
        centres = unit(np.stack([rows.total(nearest == i) if (nearest == i).any() else centres[i] for i in range(len(centres))]))
    return centres


def fit(languages: list[str], labels: np.ndarray, counts: Rows, centroids: int = CENTROIDS, seed: int = 11) -> Centroids:
    """Weights, centroids and rejection bounds from counted texts. A language's bound lies ``REJECT_MARGIN`` of the way below the
    cosine that all but ``REJECT_QUANTILE`` of its own texts reach."""
    if not languages:
        return Centroids([], np.zeros(FEATURES), np.zeros((0, FEATURES), np.float32), np.zeros(0, int), np.zeros(0))
    idf = (np.log((1 + len(counts)) / (1 + np.bincount(counts.at, minlength=FEATURES))) + 0.1).astype(np.float32)
    value = np.log1p(counts.value, dtype=np.float32) * idf[counts.at]
    length = np.sqrt(np.add.reduceat(value * value, counts.start[:-1]))
    rows = Rows(counts.start, counts.at, value / np.maximum(length, 1e-12)[counts.of()])
    found, owner, least = [], [], []
    for i in range(len(languages)):
        own = rows.pick(np.nonzero(labels == i)[0])
        centres = cluster(own, centroids, seed + i)
        found.append(centres)
        owner += [i] * len(centres)
        least.append(REJECT_MARGIN * float(np.quantile(own.cosines(centres).max(1), REJECT_QUANTILE)))
    return Centroids(list(languages), idf, np.vstack(found).astype(np.float32), np.array(owner), np.array(least))


def learning_fold(doc_id) -> F.Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % FOLDS != 0, F.lit(False))


def train(docs: DataFrame, per_language: int = SAMPLE_PER_LANGUAGE, most_languages: int = MOST_LANGUAGES) -> Centroids:
    """Learns from a sample of labelled documents outside the held-out fold: about ``per_language`` of each of the ``most_languages``
    most frequent labels (``MOST_SAMPLES`` in all), those with the least hashes. Executors count n-grams; only counts reach
    the driver."""
    rows = docs.where(learning_fold("doc_id") & F.col("lang").isNotNull()).select(
        F.col("text").cast("string"), F.col("lang").cast("string"), F.xxhash64("doc_id", "text").alias("order"))
    sizes = rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(most_languages).collect()
    languages = sorted(r.lang for r in sizes)
    if not languages:
        return fit([], np.zeros(0), Rows(np.zeros(1, np.int64), np.zeros(0, np.int64), np.zeros(0)))
    per_language = min(per_language, -(-MOST_SAMPLES // len(languages)))
    bound = {r.lang: min(2**63 - 1, int(2**64 * min(1.0, per_language / r["count"])) - 2**63) for r in sizes}
    chosen = F.create_map(*[F.lit(x) for pair in bound.items() for x in pair])
    number = F.create_map(*[F.lit(x) for i, lang in enumerate(languages) for x in (lang, i)])
    sample = rows.where(F.col("order") <= chosen[F.col("lang")]).select(number[F.col("lang")].alias("label"), "text", "order")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep, grams, values = [], [], []
            for i, text in enumerate(column_bytes(batch.column(1))):
                counts = gram_counts(text.decode("utf-8", "replace"))
                if counts is not None:
                    at = np.nonzero(counts)[0]
                    keep.append(i)
                    grams.append(at.astype("<u2").tobytes())
                    values.append(counts[at].astype("<u4").tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(keep, pa.int64())), batch.column(2).take(pa.array(keep, pa.int64())),
                                              pa.array(grams, pa.binary()), pa.array(values, pa.binary())],
                                             names=["label", "order", "grams", "counts"])

    found = stored(map_batches(sample, run, "label int, order long, grams binary, counts binary"), "grams").collect()
    found.sort(key=lambda r: (r.label, r.order))
    known = sorted({r.label for r in found})
    at = [np.frombuffer(r.grams, "<u2") for r in found]
    counts = Rows(np.concatenate([[0], np.cumsum([len(x) for x in at])]).astype(np.int64), np.concatenate([np.zeros(0, np.int64), *at]).astype(np.int64),
                  np.concatenate([np.zeros(0, np.float32), *(np.frombuffer(r.counts, "<u4") for r in found)]).astype(np.float32))
    return fit([languages[i] for i in known], np.array([known.index(r.label) for r in found], np.int64), counts)


def identify(docs: DataFrame, model: Centroids) -> DataFrame:
    """Given columns and lang_pred, score, rejected. Only the text is looked at.

    Null text or text without a letter is ``und`` with score 0, and rejected. Repeated rows get equal answers; columns of these names are
    replaced, all others kept; an empty table gives no rows.
    """
    names = [c for c in docs.columns if c not in ("lang_pred", "score", "rejected")]
    at = names.index("text")
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shared.value.predict(t.decode("utf-8", "replace")) for t in column_bytes(batch.column(at))]
            columns = [pa.array([f[i] for f in found], kind) for i, kind in enumerate((pa.string(), pa.float64(), pa.bool_()))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names=[*names, "lang_pred", "score", "rejected"])

    given = docs.select(*names)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in given.schema.fields)
    return map_batches(given, run, f"{schema}, lang_pred string, score double, rejected boolean")


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = identify(docs.select("doc_id", "text"), train(docs))
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % FOLDS == 0, F.lit(False))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "rejected")
