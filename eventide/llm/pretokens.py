"""Pre-tokens of a batch of texts, cut in whole arrays of bytes.

For texts of ASCII and Latin-1 letters the cuts of both kinds of byte-level BPE
files follow from the class of each byte and its neighbours. Other words (and
control characters, and what may begin an added token) are left as whole units
that are marked hard: the tokenizer itself has to cut them.
"""

from __future__ import annotations

import codecs
import re
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

SPACE, LETTER, DIGIT, OTHER, HARD, END = range(6)
#: Bytes of text that are cut at a time (the arrays of a run take some ten times as much).
CHUNK_BYTES = 6 << 20
#: A space between two others than white space (of any kind).
SINGLE_SPACE = re.compile(r"\S (?=\S)")
_CLASS = np.full(256, HARD, np.uint8)
_CLASS[0x21:0x7F] = OTHER
for _a, _b, _c in ((0x09, 0x0E, SPACE), (0x20, 0x21, SPACE), (0x30, 0x3A, DIGIT), (0x41, 0x5B, LETTER), (0x61, 0x7B, LETTER)):
    _CLASS[_a:_b] = _c
#: The characters by which byte-level BPE names bytes: printable ones name themselves, the others follow from 256 on.
_NAMED = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
BYTE_NAMES = {b: 256 + n for n, b in enumerate(sorted(set(range(256)) - set(_NAMED)))}
_NAMES = "".join(chr(BYTE_NAMES.get(b, b)) for b in range(256))


def byte_names(part: str) -> str:
    """A pre-token in the characters that name its UTF-8 bytes."""
    return part if part.isascii() and part.isalnum() else codecs.charmap_decode(part.encode(), "strict", _NAMES)[0]


def _bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of the texts (no nulls) joined, and their offsets."""
    at = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset:texts.offset + len(texts) + 1]
    if not len(texts) or texts.buffers()[2] is None:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    return np.frombuffer(texts.buffers()[2], np.uint8)[at[0]:at[-1]], at.astype(np.int64) - at[0]


def _strings(offsets: np.ndarray, data: np.ndarray) -> pa.Array:
    return pa.StringArray.from_buffers(len(offsets) - 1, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data)))


class _Bytes:
    """Bytes of a batch with their classes and neighbours."""

    def __init__(self, texts: pa.Array):
        self.b, self.offsets = _bytes(texts)
        b, n = self.b, len(self.b)
        self.first = np.zeros(n + 1, bool)  # first bytes of texts, and the end
        self.first[self.offsets] = True
        after = np.append(b[1:], np.uint8(0))
        cls = _CLASS[b]
        lead = np.flatnonzero((b == 0xC3) & (after != 0x97) & (after != 0xB7))  # Latin-1 letters, two bytes each
        cls[lead] = LETTER
        cls[lead + 1] = LETTER
        cls[(b == 0x3C) & (after == 0x7C)] = HARD  # may begin an added token
        self.cls, self.latin = cls, lead
        self.before = np.concatenate(([END], cls[:-1])).astype(np.uint8) if n else cls
        self.before[self.first[:n]] = END
        word = (cls != SPACE) & ((self.before == SPACE) | (self.before == END))
        hard = cls == HARD
        if hard.any():  # spread over its word
            at = np.cumsum(word, dtype=np.int32)
            of_word = np.zeros(int(at[-1]) + 1, bool)
            of_word[at[hard]] = True
            hard = of_word[at] & (cls != SPACE)
        self.word, self.hard = word, hard

    def contractions(self, start: np.ndarray) -> None:
        """Cut 's, 't, 're, 've, 'm, 'll and 'd where a pre-token starts with the apostrophe."""
        b, n = self.b, len(self.b)
        at = np.flatnonzero(start & (b == 0x27) & ~self.hard)
        inside = np.append(b, np.zeros(3, np.uint8))
        one = np.where(self.first[np.minimum(at + 1, n)], 0, inside[at + 1]) | 0x20
        two = np.where((one == 0x20) | self.first[np.minimum(at + 2, n)], 0, inside[at + 2]) | 0x20
        raw_one, raw_two = inside[at + 1], inside[at + 2]
        if not self.fold:  # letters of either case only where texts are lower-cased
            one, two = np.where(one == raw_one, one, 0), np.where(two == raw_two, two, 0)
        pair = one.astype(np.int32) << 8 | two
        short = np.isin(one, np.frombuffer(b"stmd", np.uint8))
        long = np.isin(pair, [0x7265, 0x7665, 0x6C6C])
        for hit, size in ((short, 2), (long, 3)):
            k = at[hit]
            start[k + 1] = False
            k = k + size
            k = k[k < n]
            start[k[~self.first[k] & (self.cls[k] != SPACE)]] = True

    fold = False


def cut_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Units (lower-cased but for hard ones), whether each is hard, and the units before each text: runs of letters,
    single digits and runs of other characters, without white space."""
    t = _Bytes(texts)
    t.fold = True
    start = t.word | ((t.cls != SPACE) & ~t.hard & ((t.cls != t.before) | (t.cls == DIGIT)))
    t.contractions(start)
    b = t.b.copy()
    b[(b >= 0x41) & (b <= 0x5A) & ~t.hard] += 0x20
    second = t.latin + 1
    second = second[(b[second] >= 0x80) & (b[second] <= 0x9E) & ~t.hard[second]]
    b[second] += 0x20
    kept = t.cls != SPACE
    at = np.flatnonzero(start)
    place = np.cumsum(kept, dtype=np.int32)[at] - 1
    return _strings(np.append(place, int(kept.sum())), b[kept]), t.hard[at], np.searchsorted(at, t.offsets)


def cut_bytes(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """As :func:`cut_words` for byte-level BPE: a space goes with what follows it, numbers are runs, nothing is dropped."""
    t = _Bytes(texts)
    b, n, space = t.b, len(t.b), t.cls == SPACE
    after = np.append(t.cls[1:], np.uint8(END)) if n else t.cls
    after[t.first[1:]] = END
    blank = np.zeros(n, bool)  # follows a space of the same text
    blank[1:] = (b[:-1] == 0x20) & ~t.first[1:n]
    start = np.where(space, (t.before != SPACE) | ((after != SPACE) & (after != END)),
                     (t.word | (~t.hard & (t.cls != t.before))) & ~blank)
    t.contractions(start)
    at = np.flatnonzero(start)
    hard = t.hard[at].copy()
    lead = np.flatnonzero((b[at] == 0x20) & (at + 1 < n))
    lead = lead[~t.first[at[lead] + 1]]
    hard[lead] |= t.hard[at[lead] + 1]
    return _strings(np.append(at, n), b), hard, np.searchsorted(at, t.offsets)


def merged(batches: Iterator[pa.RecordBatch], size: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Neighbouring batches joined up to ``size`` bytes, so that more words of a batch repeat."""
    held: list[pa.RecordBatch] = []
    for b in batches:
        if held and sum(x.nbytes for x in held) + b.nbytes > size:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held = []
        held.append(b)
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def parts(texts: pa.Array, size: int = CHUNK_BYTES) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """Texts in runs of about ``size`` bytes, each with the number of texts that end after each of its strings (0 or 1).

    A longer text is cut before single spaces, where neither kind of file has a pre-token.
    """
    at = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64) if len(texts) else [0]
    a = 0
    while a < len(texts):
        b = max(a + 1, int(np.searchsorted(at, at[a] + size, "right")) - 1)
        if b > a + 1 or at[b] - at[a] <= size:
            yield texts.slice(a, b - a), np.ones(b - a, np.int64)
        else:
            left = texts[a].as_py()
            while left:
                m = SINGLE_SPACE.search(left, size // 2)
                cut = m.start() + 1 if m else len(left)
                yield pa.array([left[:cut]], pa.string()), np.array([int(cut == len(left))])
                left = left[cut:]
        a = b


class Units(dict):
    """Ids (bytes of ``<u4``) of units; plain ones are encoded by the tokenizer's model, hard ones by ``library``."""

    def __init__(self, model, library, limit: int = 1_000_000, max_cached: int = 64):
        super().__init__()
        self.model, self.library, self.limit, self.max_cached = model, library, limit, max_cached

    def ids(self, units: list[str], hard: np.ndarray) -> list[bytes]:
        if len(self) > self.limit:
            self.clear()
        out = list(map(self.get, units))
        if None in out:
            tokenize, room, rest = self.model.tokenize, self.max_cached, []
            for n, x in enumerate(out):
                if x is None:
                    u = units[n]
                    if hard[n]:
                        rest.append(n)
                        continue
                    out[n] = x = array("I", [t.id for t in tokenize(byte_names(u))]).tobytes()
                    if len(u) <= room:
                        self[u] = x
            for n, x in zip(rest, self.library([units[n] for n in rest])):
                out[n] = x
                if len(units[n]) <= room:
                    self[units[n]] = x
        return out

    def spread(self, units: pa.Array, hard: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all units joined, and where each text's ids begin: each distinct unit is encoded once, then copied."""
        coded = units.dictionary_encode()
        at = coded.indices.to_numpy()
        of_unit = np.zeros(len(coded.dictionary), bool)
        of_unit[at] = hard  # equal units are hard alike
        ids = self.ids(coded.dictionary.to_numpy(zero_copy_only=False).tolist(), of_unit)
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) >> 2
        flat, lengths = np.frombuffer(b"".join(ids), "<u4"), sizes[at]
        before = np.concatenate(([0], np.cumsum(lengths)))
        first = (np.cumsum(sizes) - sizes)[at]
        return flat[np.repeat(first - before[:-1], lengths) + np.arange(before[-1])], before[bounds]

    def encode(self, texts: pa.Array, cut: Callable) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts (no nulls) joined, and where each text's ids begin (one more than texts)."""
        out, bounds, done = [], [np.zeros(1, np.int64)], 0
        for run, ends in parts(texts):
            ids, at = self.spread(*cut(run))
            out.append(ids)
            bounds.append(at[1:][ends == 1] + done)
            done += len(ids)
        return np.concatenate(out) if out else np.zeros(0, "<u4"), np.concatenate(bounds)
