"""Token ids of whole texts by a public tokenizer file."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from pageprism.llm.common import spread_ranges

SLICE_BYTES = 1 << 20
FLUSH_BYTES = 2 << 20  # of text looked up at once
BLANKS = b" \t\n\r\x0b\x0c"
#: Letters a-z and the letters of Latin-1 in UTF-8, with a stop or comma behind or not.
PLAIN = re.compile(rb"(?:[a-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+[.,]?")
#: Those among them that hold small letters only: normalising leaves them as they are, and they are one word.
SMALL = re.compile(rb"(?:[a-z]|\xc3[\x9f-\xb6\xb8-\xbf])+")
JOINED = 256
MARKS = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
#: By byte: small letters, and the second bytes of letters of Latin-1 behind LATIN.
LETTER = np.isin(np.arange(256), range(97, 123))
SECOND = np.isin(np.arange(256), [*range(0x80, 0x97), *range(0x98, 0xB7), *range(0xB8, 0xC0)])
LATIN = 0xC3


def default_tokenizer() -> str:
    """Path of the 49k word tokenizer among the installed public tokenizer files."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def tokenizer_text(path: str) -> str:
    """Content of a tokenizer file (some MB): read once on the driver and sent with the tasks, so that executors
    need not have the file."""
    with open(path, encoding="utf-8") as f:
        return f.read()


class _Index(dict):
    """Number of each chunk; a new chunk gets the next one and is noted for encoding."""

    def __init__(self):
        super().__init__()
        self.fresh: list[bytes] = []

    def __missing__(self, chunk: bytes) -> int:
        self.fresh.append(chunk)
        n = self[chunk] = len(self)
        return n


class TextEncoder:
    """Encodes texts with the tokenizers library.

    A tokenizer that drops white space and never joins text across it gives a text the ids of its blank-separated
    chunks, one after another; then each chunk is encoded once and looked up afterwards (``most_chunks`` bounds the
    memory: beyond it only chunks stay that came again since they were learned). Capitals A-Z are folded first if the tokenizer
    folds them itself, except in slices that may hold a special token; where the tokenizer always cuts between a letter and
    a mark, a chunk ends there too. Other tokenizers get whole texts.
    """

    def __init__(self, tokenizer_json: str, most_chunks: int = 160_000):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        self.most_chunks = most_chunks
        ids = lambda t: self.tokenizer.encode(t, add_special_tokens=False).ids
        self.by_chunk = not ids(" \n\t\r\x0b\x0c") and all(ids(f"{a}{chr(b)}b") == ids(a) + ids("b")
                                                           for a in ("a", "-", "é") for b in BLANKS)
        self.folds = ids("ABCDEFGHIJKLMNOPQRSTUVWXYZ aB") == ids("abcdefghijklmnopqrstuvwxyz ab")
        self.word_ends = self._word_ends() if self.by_chunk else None
        self.marks = self._cut_marks() if self.by_chunk else None
        self.bare = self._for_words(Tokenizer(self.tokenizer.model))
        self._reset()

    def _cut_marks(self) -> np.ndarray:
        """By byte, whether it is a mark that the tokenizer always encodes apart from letters before it."""
        ids = lambda t: self.tokenizer.encode(t, add_special_tokens=False).ids
        special = {c for t in self.tokenizer.get_added_tokens_decoder().values() for c in t.content}
        words, cut = [(w, ids(w)) for w in ("a", "zzqxjv", "1s", "-t", "né", "À")], np.zeros(256, bool)
        for mark in map(chr, MARKS):
            rests = [(r, ids(r)) for r in (mark, mark * 3, f"{mark}.", f"{mark}-a", f"{mark}s", f"{mark}re", f"{mark}é", f"{mark}1")]
            cut[ord(mark)] = mark not in special and all(ids(w + r) == own + behind for w, own in words for r, behind in rests)
        return cut

    def _for_words(self, bare):
        """A tokenizer of the same model (which both hold together) without normaliser, and cutting at blanks alone, for words of small letters; the tokenizer itself if it doesn't leave them as they are."""
        from tokenizers import normalizers, pre_tokenizers

        letters = list(map(chr, [*range(97, 123), *range(0xDF, 0xF7), *range(0xF8, 0x100)]))
        text = " ".join([*letters, "".join(letters), "".join(letters[::-1])])
        given = self.tokenizer.normalizer
        if given is not None and given.normalize_str(text) != text:
            return self.tokenizer
        bare.normalizer, bare.pre_tokenizer = normalizers.Sequence([]), self.tokenizer.pre_tokenizer
        blanks = pre_tokenizers.CharDelimiterSplit(" ")
        for cut in (blanks, pre_tokenizers.Sequence([blanks, pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])):
            if bare.pre_tokenizer is not None and bare.pre_tokenizer.pre_tokenize_str(text) == cut.pre_tokenize_str(text):
                bare.pre_tokenizer = cut
                break
        return bare

    def _word_ends(self) -> np.ndarray | None:
        """By id, whether a word ends there; None where the vocabulary doesn't tell or a word in two forms does not keep to it."""
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        if not suffix:
            return None
        ends = np.zeros(self.tokenizer.get_vocab_size(), bool)
        for token, i in self.tokenizer.get_vocab().items():
            ends[i] = token.endswith(suffix)
        ids = lambda t: self.tokenizer.encode(t, add_special_tokens=False).ids
        tried = ("ab.", "zzqxjv,", "éàüñ.", "ß,")
        kept = all(ends[ids(t)].sum() == 2 and ids(t) == ids(t[:-1]) + ids(t[-1]) for t in tried)
        return ends if kept else None

    def _reset(self) -> None:
        self.index = _Index()
        self.flat = np.zeros(1 << 16, np.uint32)
        self.ends = np.zeros(1 << 16, np.int32)  # where the ids of a chunk end and those of the next begin
        self.again = np.zeros(1 << 16, bool)

    def _forget(self) -> None:
        """Keeps the chunks that came again since they were learned; none, if they are more than half of what may be held."""
        kept = np.flatnonzero(self.again[:len(self.index)])
        chunks, first, size = list(self.index), self.ends[kept], self.ends[kept + 1] - self.ends[kept]
        ids = self.flat[spread_ranges(first, size)]
        self._reset()
        if len(kept) <= self.most_chunks // 2:
            self.index.update(zip(map(chunks.__getitem__, kept.tolist()), range(len(kept))))
            self._store(ids, size, 0)

    def _store(self, ids: np.ndarray, size: np.ndarray, known: int) -> None:
        """Adds the ids of chunks, which follow the ``known`` ones."""
        used = int(self.ends[known])
        while used + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros(len(self.flat), np.uint32)])
        while known + len(size) >= len(self.ends):
            self.ends, self.again = (np.concatenate([x, np.zeros(len(x), x.dtype)]) for x in (self.ends, self.again))
        self.flat[used:used + len(ids)] = ids
        self.ends[known + 1:known + 1 + len(size)] = used + np.cumsum(size)

    def _learn(self) -> None:
        """Ids of the chunks that are new. Runs of plain letters, perhaps with a stop or comma behind, are one or two words to the
        tokenizer; many of them are encoded as one text, which is cut again where words end."""
        fresh, self.index.fresh = self.index.fresh, []
        if not fresh:
            return
        size = np.zeros(len(fresh), np.int64)
        parts: list[np.ndarray] = []
        order: list[np.ndarray] = []
        for group, joined in self._by_form(fresh):
            for i in range(0, len(group), JOINED):
                own = np.array(group[i:i + JOINED])
                chunks = [fresh[k] for k in group[i:i + JOINED]]
                if joined:
                    ids = np.array(joined.encode_batch_fast([b" ".join(chunks).decode()], add_special_tokens=False)[0].ids, np.uint32)
                    ends = np.nonzero(self.word_ends[ids])[0] + 1
                    words = np.cumsum([1 + (c[-1] in b".,") for c in chunks])
                    size[own] = np.diff(ends[words - 1], prepend=0)
                else:
                    texts = [c.decode("utf-8", "replace") for c in chunks]
                    found = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
                    size[own] = np.fromiter(map(len, found), np.int64, len(found))
                    ids = np.fromiter(chain.from_iterable(found), np.uint32)
                parts.append(ids)
                order.append(own)
        turn, first = np.concatenate(order), np.zeros(len(fresh), np.int64)
        first[turn] = np.cumsum(size[turn]) - size[turn]
        self._store(np.concatenate(parts)[spread_ranges(first, size)], size, len(self.index) - len(fresh))

    def _by_form(self, fresh: list[bytes]) -> list[tuple[list[int], object]]:
        """Chunks by the tokenizer that takes many as one text; None where each is encoded alone."""
        if self.word_ends is None:
            return [(list(range(len(fresh))), None)]
        small, plain, other = [], [], []
        for k, chunk in enumerate(fresh):
            if chunk.isalpha() and chunk.islower():  # ASCII only
                small.append(k)
            else:
                (small if SMALL.fullmatch(chunk) else plain if PLAIN.fullmatch(chunk) else other).append(k)
        return [(small, self.bare), (plain, self.tokenizer), (other, None)]

    def _chunks(self, pieces: list[bytes]) -> pa.ListArray:
        """The chunks of each piece."""
        folded = pa.array([p.lower() if self.folds and b"<|" not in p else p for p in pieces], pa.binary())
        if self.marks.any():
            folded = _with_blanks(folded, self.marks)
        return pc.ascii_split_whitespace(folded.view(pa.string()))

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after another, and the number of ids of each text."""
        if not self.by_chunk:
            found = [self.tokenizer.encode(t.decode("utf-8", "replace"), add_special_tokens=False).ids for t in texts]
            return (np.fromiter((x for ids in found for x in ids), np.uint32),
                    np.fromiter(map(len, found), np.int64, len(found)))
        parts, counts = [], np.zeros(len(texts), np.int64)
        pieces: list[bytes] = []
        owners: list[int] = []  # text of each piece
        held = 0
        for i, text in enumerate(texts):
            for piece in slices(text):
                pieces.append(piece)
                owners.append(i)
                held += len(piece)
                if held >= FLUSH_BYTES:
                    parts.append(self._flush(pieces, owners, counts))
                    pieces, owners, held = [], [], 0
        parts.append(self._flush(pieces, owners, counts))
        return np.concatenate(parts), counts

    def _flush(self, pieces: list[bytes], owners: list[int], counts: np.ndarray) -> np.ndarray:
        if not pieces:
            return np.zeros(0, np.uint32)
        if len(self.index) > self.most_chunks:
            self._forget()
        chunks = self._chunks(pieces)
        found = chunks.values.dictionary_encode()
        distinct = found.dictionary.view(pa.binary()).to_pylist()
        known = len(self.index)
        at = np.fromiter(map(self.index.__getitem__, distinct), np.int64, len(distinct))
        self._learn()
        self.again[at[at < known]] = True
        held = pa.ListArray.from_arrays(self.ends[:len(self.index) + 1], self.flat[:self.ends[len(self.index)]])
        ids = held.take(pa.array(at)).take(found.indices)
        np.add.at(counts, owners, np.diff(ids.offsets.to_numpy()[chunks.offsets.to_numpy()]))
        return ids.values.to_numpy()


def _with_blanks(texts: pa.BinaryArray, marks: np.ndarray) -> pa.BinaryArray:
    """Texts with a blank before each of the marks that stands behind a letter."""
    _, starts, data = texts.buffers()
    starts = np.frombuffer(starts, np.int32)[texts.offset:texts.offset + len(texts) + 1]
    row = np.frombuffer(data, np.uint8)[:starts[-1]] if data else np.zeros(0, np.uint8)
    at = np.flatnonzero(marks[row])
    at = at[at > 1]
    at = at[LETTER[row[at - 1]] | SECOND[row[at - 1]] & (row[at - 2] == LATIN)]
    moved = (starts + np.searchsorted(at, starts)).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(texts), [None, pa.py_buffer(moved), pa.py_buffer(np.insert(row, at, 32))])


def slices(text: bytes, most: int = SLICE_BYTES) -> Iterator[bytes]:
    """A text in pieces that end at a blank, of about ``most`` bytes; a longer run without blanks stays whole."""
    start = 0
    while len(text) - start > most:
        cuts = [c for c in (text.find(b, start + most) for b in (b" ", b"\n")) if c >= 0]
        if not cuts:
            break
        yield text[start:min(cuts)]
        start = min(cuts)
    yield text[start:]


@lru_cache(maxsize=2)
def encoder(tokenizer_json: str) -> TextEncoder:
    """One encoder per Python worker, kept from task to task."""
    return TextEncoder(tokenizer_json)
