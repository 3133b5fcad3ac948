"""Exact token counts of whole texts; huge texts are encoded in overlapping chunks that are spliced where both sides provably agree.

A seam lies between two chunks that overlap. Each side lists the cuts that it sees in the overlap, away from its own ends:

* tokenizers that first split text into words by scanning it from left to right: places where a word begins. If a word begins at one place in
  both chunks, both scans are in the same state there, so the left chunk is right before it and the right chunk behind it;
* byte-pair encoding without such words: tokens that both chunks hold at one place. A merge across an end of such a token
  would be the next merge in one of the chunks too, where there is none; so the left chunk's tokens up to it and the right chunk's behind it are those of
  the whole text.

Any cut that both sides list will do. A text with a seam where they list none is encoded again with wider overlaps, at last as a whole.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pageprism.llm.common import column_bytes, groups_by_bytes, map_batches, table
from pageprism.llm.tokens import default_tokenizer, encoder, tokenizer_text
from pageprism.session import stored

LIMIT = 2048
CHUNK_CHARS = 32_768
OVERLAP_CHARS = 1024
#: Cuts keep so many characters away from the ends of a chunk: more than any special token or look-ahead of a scan takes.
MARGIN = 64
WIDEN = 4
TASK_CHARS = 2 << 20

#: Steps of a tokenizer file whose result at a place depends on its near surroundings alone.
LOCAL_NORMALIZERS = {"NFC", "NFD", "NFKC", "NFKD", "Lowercase", "StripAccents", "Prepend", "Strip", "Nmt"}
LOCAL_SPLITS = {"ByteLevel", "Split", "Whitespace", "WhitespaceSplit", "Punctuation", "Digits", "BertPreTokenizer"}

_CUTS = "array<struct<place:long,size:int,id:int>>"
_ZONES = f"id long, seam int, right boolean, cuts {_CUTS}, before array<long>, total long"


def _steps(step: dict | None, inner: str) -> list[dict]:
    if step is None:
        return []
    return [x for s in step[inner] for x in _steps(s, inner)] if step["type"] == "Sequence" else [step]


class Coder:
    """A tokenizer file of either library: counts of whole texts, and cuts of chunks."""

    def __init__(self, content: bytes, path: str):
        self.is_json = not path.endswith(".model")
        if self.is_json:
            from tokenizers import Tokenizer

            text = content.decode()
            self.plain = encoder(text)
            self.tokenizer = Tokenizer.from_str(text)
            self.tokenizer.no_truncation()
            self.tokenizer.no_padding()
            self.by_words, self.cuttable = self._locality(json.loads(text), self.tokenizer)
        else:
            import sentencepiece

            self.tokenizer = sentencepiece.SentencePieceProcessor(model_proto=content)
            self.by_words, self.cuttable = False, self._merges_pairs()

    @staticmethod
    def _locality(file: dict, tokenizer) -> tuple[bool, bool]:
        """Whether words are split off first, and whether cuts can be proven at all."""
        normal = all(s["type"] in LOCAL_NORMALIZERS or s["type"] == "Replace" and s["pattern"] in ({"Regex": r"\s+"}, {"String": " "})
                     for s in _steps(file.get("normalizer"), "normalizers"))
        splits = _steps(file.get("pre_tokenizer"), "pretokenizers")
        short = all(len(t.content) < MARGIN for t in tokenizer.get_added_tokens_decoder().values())
        scans = all(s["type"] in LOCAL_SPLITS for s in splits)
        words = any(s["type"] != "ByteLevel" or s.get("use_regex", True) for s in splits)
        model = file["model"]
        pairs = model["type"] == "BPE" and not model.get("dropout") and not model.get("ignore_merges")
        return words, normal and short and scans and (words or pairs)

    def _merges_pairs(self) -> bool:
        """Of the library's models only those that merge pairs have no n best encodings and cut words into smaller pieces than words."""
        try:
            self.tokenizer.NBestEncodeAsIds("ab", 2)
        except Exception:
            return self.tokenizer.encode("ab ab", out_type=str) != ["ab", "ab"]
        return False

    def counts(self, texts: list[bytes]) -> np.ndarray:
        if self.is_json:
            return self.plain.encode(texts)[1]
        found = self.tokenizer.encode([t.decode("utf-8", "replace") for t in texts], num_threads=1)
        return np.fromiter(map(len, found), np.int64, len(found))

    def tokens(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray | None]:
        """Start, end and id of each token (in characters, or in UTF-8 bytes for sentencepiece), and whether a word begins with it."""
        if self.is_json:
            found = self.tokenizer.encode(text, add_special_tokens=False)
            spans = np.array(found.offsets, np.int64).reshape(-1, 2)
            word = np.array([-1 if w is None else w for w in found.word_ids], np.int64)
            return spans[:, 0], spans[:, 1], np.array(found.ids, np.int64), np.diff(word, prepend=-2) != 0
        pieces = self.tokenizer.encode(text, return_type="proto").pieces
        rows = np.array([(p.begin, p.end, p.id) for p in pieces], np.int64).reshape(-1, 3)
        return rows[:, 0], rows[:, 1], rows[:, 2], None

    def cuts(self, text: str, tokens, low: int, high: int) -> tuple[list[tuple[int, int, int]], list[int]]:
        """Cuts (place, size, id) between two places of a chunk, and how many tokens are before each."""
        starts, ends, ids, begins = tokens
        if self.by_words:
            at = np.nonzero((starts >= low) & (starts < high) & begins)[0]
            at = at[np.unique(starts[at], return_index=True)[1]]
            at = [i for i in at.tolist() if _stands_alone(text[starts[i]])]
            return [(int(starts[i]), 0, 0) for i in at], at
        at = np.nonzero((starts >= low) & (ends <= high) & (ends > starts))[0].tolist()
        return [(int(starts[i]), int(ends[i] - starts[i]), int(ids[i])) for i in at], at


@lru_cache(maxsize=2)
def _coder(content: bytes, path: str) -> Coder:
    return Coder(content, path)


@lru_cache(maxsize=1 << 12)
def _stands_alone(char: str) -> bool:
    """No normaliser joins the character with the one before it, or makes several of it."""
    if char.isascii():
        return True
    return (not unicodedata.category(char).startswith("M") and not 0x1100 <= ord(char) < 0x1200 and len(char.lower()) == 1
            and unicodedata.normalize("NFKD", char)[0] != " " and all(unicodedata.is_normalized(form, char) for form in ("NFC", "NFKC")))


def chunk_ranges(length: int, chunk: int, overlap: int) -> list[tuple[int, int]]:
    """Ranges of a text; neighbours overlap by ``overlap`` characters around each seam."""
    seams = list(range(chunk, length - overlap, chunk))
    return [(a, b) for a, b in zip([0] + [s - overlap // 2 for s in seams], [s + overlap - overlap // 2 for s in seams] + [length])]


def _cut(chunk: int, overlap: int, in_bytes: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ranges = chunk_ranges(len(value), chunk, overlap)
                place = done = 0
                for i, (a, b) in enumerate(ranges):
                    place += len(value[done:a].encode()) if in_bytes else a - done
                    done = a
                    yield pa.RecordBatch.from_pydict({
                        "id": pa.array([key], pa.int64()), "number": pa.array([i], pa.int32()), "last": [i == len(ranges) - 1],
                        "start": pa.array([place], pa.int64()), "text": [value[a:b]]})

    return run


def _encode(shared, path: str, overlap: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(shared.value, path)
        for batch in batches:
            for row in batch.to_pylist():
                text, tokens = row["text"], coder.tokens(row["text"])
                size = (lambda part: len(part)) if coder.is_json else (lambda part: len(part.encode()))
                zones = []
                for right, seam in ((True, row["number"]), (False, row["number"] + 1)):
                    if right and not seam or not right and row["last"]:
                        continue
                    a, b = (0, overlap) if right else (len(text) - overlap, len(text))
                    low, high = size(text[:a + MARGIN]), size(text[:max(a + MARGIN, b - MARGIN)])
                    cuts, before = coder.cuts(text, tokens, low, high)
                    zones.append((seam, right, [(p + row["start"], s, i) for p, s, i in cuts], before, None))
                if row["last"]:
                    zones.append((None, None, None, None, len(tokens[0])))
                yield pa.RecordBatch.from_arrays([
                    pa.array([row["id"]] * len(zones), pa.int64()), pa.array([z[0] for z in zones], pa.int32()),
                    pa.array([z[1] for z in zones], pa.bool_()),
                    pa.array([z[2] and [{"place": p, "size": s, "id": i} for p, s, i in z[2]] for z in zones],
                             pa.list_(pa.struct([("place", pa.int64()), ("size", pa.int32()), ("id", pa.int32())]))),
                    pa.array([z[3] for z in zones], pa.list_(pa.int64())), pa.array([z[4] for z in zones], pa.int64())],
                    names=["id", "seam", "right", "cuts", "before", "total"])

    return run


def splice(zones: DataFrame) -> DataFrame:
    """(id, n_tokens, failed) from the cuts of both sides of each seam: the tokens of the last chunk, and for each seam those that the
    left chunk has before the first common cut less those that the right chunk has before it. ``failed``: seams without a common cut."""
    side = lambda right: F.max(F.when(F.col("right") == right, F.struct("cuts", "before")))
    seams = zones.groupBy("id", "seam").agg(side(False).alias("l"), side(True).alias("r"), F.max("total").alias("total"))
    common = F.array_min(F.array_intersect(F.coalesce("l.cuts", F.array().cast(_CUTS)), F.coalesce("r.cuts", F.array().cast(_CUTS))))
    seams = seams.withColumn("cut", common)
    before = lambda s: F.element_at(f"{s}.before", F.array_position(f"{s}.cuts", F.col("cut")).cast("int"))
    gain = F.when(F.col("cut").isNotNull(), before("l") - before("r"))
    return seams.groupBy("id").agg((F.sum(F.coalesce(gain, "total", F.lit(0)))).cast("long").alias("n_tokens"),
                                   F.count_if(F.col("seam").isNotNull() & F.col("cut").isNull()).alias("failed"))


def _long_counts(texts: DataFrame, content, path: str, chunk: int, overlap: int) -> DataFrame:
    """(id, n_tokens) of (id, text, n_chars) by overlapping chunks, which any task may take."""
    is_model = path.endswith(".model")
    found = []
    while True:
        held = texts.agg(F.sum("n_chars")).first()[0] or 0
        if not held:
            break
        chunks = map_batches(texts.select("id", "text"), _cut(chunk, overlap, is_model), "id long, number int, last boolean, start long, text string")
        chunks = chunks.repartition(max(1, -(-held // TASK_CHARS)), "id", "number")
        spliced = stored(splice(map_batches(chunks, _encode(content, path, overlap), _ZONES)), "spliced")
        found.append(spliced.where("failed = 0").select("id", "n_tokens"))
        texts = texts.join(spliced.where("failed > 0").select("id"), "id", "left_semi")
        overlap *= WIDEN
        chunk = max(chunk, WIDEN * overlap)
    return reduce(DataFrame.union, found) if found else None


def count_tokens(docs: DataFrame, tokenizer_path: str | None = None, limit: int = LIMIT, chunk_chars: int = CHUNK_CHARS,
                 overlap_chars: int = OVERLAP_CHARS) -> DataFrame:
    """doc_id, n_bytes (UTF-8), n_tokens, over_limit (more than ``limit`` tokens) of every document by a ``tokenizers`` file (.json) or a
    ``sentencepiece`` model (.model), without added special tokens, truncation or padding.

    A text of more than ``chunk_chars`` characters is cut into overlapping chunks, which are dealt over all tasks, and spliced;
    where the tokenizer allows no proof of a cut, it is encoded as a whole. A null text counts as empty; a null doc_id
    stays null; each repeated row is counted; an empty table gives no rows; other columns are left out.
    """
    if overlap_chars <= 2 * MARGIN or chunk_chars <= 2 * overlap_chars:
        raise ValueError(f"overlaps must be longer than {2 * MARGIN} characters, chunks than two overlaps")
    path = tokenizer_path or default_tokenizer()
    if path.endswith(".model"):
        with open(path, "rb") as f:
            content = f.read()
    else:
        content = tokenizer_text(path).encode()
    shared = docs.sparkSession.sparkContext.broadcast(content)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context, made = TaskContext.get(), 0
        first, coder = (context.partitionId() if context else 0) << 33, _coder(shared.value, path)
        for batch in batches:
            keys, texts = batch.column(0), column_bytes(batch.column(1))
            for a, b in groups_by_bytes(texts):
                whole = [t.decode("utf-8", "replace") if coder.cuttable and len(t) > chunk_chars else None for t in texts[a:b]]
                whole = [t if t is not None and len(t) > chunk_chars else None for t in whole]
                counts = iter(coder.counts([t for t, w in zip(texts[a:b], whole) if w is None]).tolist())
                yield pa.RecordBatch.from_arrays([
                    pa.array(range(first + made, first + made + b - a), pa.int64()), keys.slice(a, b - a),
                    pa.array([len(t) for t in texts[a:b]], pa.int64()), pa.array([next(counts) if w is None else None for w in whole], pa.int64()),
                    pa.array([w and len(w) for w in whole], pa.int64()), pa.array(whole, pa.string())],
                    names=["id", "doc_id", "n_bytes", "n_tokens", "n_chars", "text"])
                made += b - a

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    first = stored(map_batches(rows, run, "id long, doc_id long, n_bytes long, n_tokens long, n_chars long, text string"), "token-counts")
    spliced = _long_counts(first.where("text IS NOT NULL").select("id", "text", "n_chars"), shared, path, chunk_chars, overlap_chars)
    short = first.where("text IS NULL").select("doc_id", "n_bytes", "n_tokens")
    if spliced is not None:
        long = first.where("text IS NOT NULL").select("id", "doc_id", "n_bytes").join(spliced, "id")
        short = short.union(long.select("doc_id", "n_bytes", "n_tokens"))
    return short.withColumn("over_limit", F.col("n_tokens") > limit)


def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"))
