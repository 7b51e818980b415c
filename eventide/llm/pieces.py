"""SentencePiece encoding and decoding by batched numpy Viterbi.

* Pieces and scores come from a public SentencePiece model file. A text is
  given a leading space, spaces become U+2581, and it is cut before every run
  of U+2581 (pieces have U+2581 only in front), so words are independent.
* The distinct words of a batch are segmented, equal lengths together: the
  substrings of every piece length are hashed from prefix sums and probed in
  the sorted piece keys (a table of hash prefixes rules out most), vectorised
  maxima store the backpointers, and all words are walked back at once. Words over ``LONG_WORD`` characters probe all their
  substrings the same way and walk their matches on their own.
* The segmentation has the highest summed score of all. Unigram files are used
  with their own scores; files of merge ranks (every score the negative
  rank) hold no probabilities, so a piece of rank r weighs -ln(r + 1) - H, H
  the log of the harmonic sum (Zipf's law over the ranks).
* A character without a piece costs ``BYTE_COST`` more than the worst piece
  and is written as its UTF-8 byte pieces.

Null text is empty; an empty text has no ids. Decoding gives the text back,
except that U+2581 in a text reads as a space, as SentencePiece itself does.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from eventide.llm.common import bounded_batches

SPACE = "▁"
BYTE_COST = 10.0
LONG_WORD = 48
#: Segmented words that a worker remembers.
CACHE_WORDS = 500_000
#: Words times characters that are segmented at a time.
CELLS = 1 << 16
NEAR_BITS = 20
_M = np.uint64(0x9E3779B97F4A7C15)
_WORD = re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")


@dataclass
class Pieces:
    keys: np.ndarray  # sorted piece hashes
    ids: np.ndarray  # piece id of each key
    scores: np.ndarray  # score of each key
    text: list[bytes]  # bytes of each id
    byte_ids: np.ndarray  # id of each byte
    unknown: float
    longest: int
    near: np.ndarray  # by the first NEAR_BITS bits of a hash: whether a key begins so


def _mix(h: np.ndarray, length: int) -> np.ndarray:
    """Final hash of substrings of one length."""
    h = h ^ np.uint64(length * 0xD6E8FEB86659FD93 & 0xFFFFFFFFFFFFFFFF)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


def _hash(codes: np.ndarray) -> np.ndarray:
    """Hash of each row of a (words, length) code point matrix."""
    h = np.zeros(len(codes), np.uint64)
    with np.errstate(over="ignore"):
        for j in range(codes.shape[1]):
            h = h * _M + codes[:, j] + np.uint64(1)
    return _mix(h, codes.shape[1])


def _codes(word: str) -> np.ndarray:
    return np.frombuffer(word.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)


def load(path: str) -> Pieces:
    """The pieces of a SentencePiece model file."""
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    n = sp.get_piece_size()
    text: list[bytes] = [b""] * n
    byte_ids = np.full(256, -1, np.int64)
    plain = []
    for i in range(n):
        p = sp.id_to_piece(i)
        if sp.is_byte(i):
            byte_ids[int(p[3:5], 16)] = i
            text[i] = bytes([int(p[3:5], 16)])
        elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
            plain.append((p, i, sp.get_score(i)))
            text[i] = p.replace(SPACE, " ").encode()
    raw = np.array([s for _, _, s in plain])
    ranks = raw[raw > -1e8]
    if len(ranks) and (ranks == np.round(ranks)).all() and len(np.unique(ranks)) == len(ranks):
        rank = np.argsort(np.argsort(-raw, kind="stable"), kind="stable")
        scores = -np.log(rank + 1.0) - np.log((1 / (np.arange(len(raw)) + 1)).sum())
    else:
        scores = raw
    keys = np.zeros(len(plain), np.uint64)
    sizes = np.array([len(p) for p, _, _ in plain], np.int64)
    for size in np.unique(sizes).tolist():
        at = np.flatnonzero(sizes == size)
        keys[at] = _hash(np.stack([_codes(plain[i][0]) for i in at.tolist()]))
    order = np.argsort(keys)
    keys = keys[order]
    if (keys[1:] == keys[:-1]).any():
        raise ValueError("two pieces share a hash")
    near = np.zeros(1 << NEAR_BITS, bool)
    near[keys >> np.uint64(64 - NEAR_BITS)] = True
    return Pieces(keys, np.array([i for _, i, _ in plain], np.int64)[order], scores[order], text, byte_ids,
                  float(scores.min()) - BYTE_COST, max(len(p) for p, _, _ in plain), near)


def _probe(p: Pieces, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the hashes that are piece keys, and the positions of these keys."""
    where = np.flatnonzero(p.near[h >> np.uint64(64 - NEAR_BITS)])
    at = np.searchsorted(p.keys, h[where])
    at[at == len(p.keys)] = 0
    hit = p.keys[at] == h[where]
    return where[hit], at[hit]


def _substrings(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Prefix hashes (length + 1, words) and powers: the hash of [i, j) is prefix[j] - prefix[i] * power[j - i]."""
    n, m = codes.shape
    prefix = np.zeros((n + 1, m), np.uint64)
    power = np.ones(n + 1, np.uint64)
    with np.errstate(over="ignore"):
        for j in range(n):
            prefix[j + 1] = prefix[j] * _M + codes[j] + np.uint64(1)
            power[j + 1] = power[j] * _M
    return prefix, power


def _viterbi(p: Pieces, words: list[str]) -> list[bytes]:
    """Best piece ids of words of one length (byte pieces for characters without one)."""
    m, n = len(words), len(words[0])
    codes = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(m, n)
    prefix, power = _substrings(codes.T.astype(np.uint64, order="C"))
    most = min(p.longest, n)
    piece = np.full((most, n, m), -1, np.int32)  # by length, start and word
    scores, some = [], []
    with np.errstate(over="ignore"):
        for length in range(1, most + 1):
            where, at = _probe(p, _mix(prefix[length:] - prefix[:-length] * power[length], length).reshape(-1))
            score = np.full((n - length + 1, m), -np.inf)
            score.reshape(-1)[where] = p.scores[at]
            piece[length - 1].reshape(-1)[where] = p.ids[at]
            scores.append(score)
            some.append((np.bincount(where // m, minlength=len(score)) > 0).tolist())
    best = np.zeros((n + 1, m))
    size = np.ones((n + 1, m), np.int8)
    for end in range(1, n + 1):
        top = best[end - 1] + p.unknown
        for length in range(1, min(most, end) + 1):
            start = end - length
            if some[length - 1][start]:
                score = best[start] + scores[length - 1][start]
                better = score > top
                np.copyto(top, score, where=better)
                np.copyto(size[end], length, where=better)
        best[end] = top
    return _walked(p, words, size, piece)


def _walked(p: Pieces, words: list[str], size: np.ndarray, piece: np.ndarray) -> list[bytes]:
    """Ids of every word, from its end over its best pieces."""
    m, n = len(words), len(words[0])
    ids, sizes, count = np.zeros((n, m), np.int32), np.zeros((n, m), np.int8), np.zeros(m, np.int64)
    word, end, k = np.arange(m), np.full(m, n), 0
    while len(word):
        step = size[end, word]
        end = end - step
        ids[k, word], sizes[k, word] = piece[step - 1, end, word], step
        count[word] += 1
        word, end, k = word[end > 0], end[end > 0], k + 1
    ends = np.cumsum(count)
    of = np.repeat(np.arange(m), count)
    back = np.repeat(ends, count) - 1 - np.arange(len(of))  # pieces of the word behind each
    flat = ids[back, of]
    data = flat.astype("<u4").tobytes()
    out = [data[4 * a:4 * b] for a, b in zip((ends - count).tolist(), ends.tolist())]
    for w in np.unique(of[flat < 0]).tolist():
        at, own = 0, []
        for i, step in zip(ids[:count[w], w][::-1].tolist(), sizes[:count[w], w][::-1].tolist()):
            own.extend([i] if i >= 0 else p.byte_ids[list(words[w][at].encode("utf-8", "surrogatepass"))].tolist())
            at += step
        out[w] = np.array(own, "<u4").tobytes()
    return out


def _long(p: Pieces, word: str) -> list[int]:
    """As _viterbi for one long word: all matches at once, then one walk over them."""
    codes = _codes(word)
    n = len(codes)
    h = np.zeros(n, np.uint64)
    edges: list[list[tuple[int, float, int]]] = [[] for _ in range(n + 1)]
    with np.errstate(over="ignore"):
        for length in range(1, min(p.longest, n) + 1):
            h = h[:n - length + 1] * _M + codes[length - 1:] + np.uint64(1)
            for i, a in zip(*(x.tolist() for x in _probe(p, _mix(h, length)))):
                edges[i + length].append((length, p.scores[a], int(p.ids[a])))
    best = [0.0] * (n + 1)
    size, piece = [1] * (n + 1), [-1] * (n + 1)
    for end in range(1, n + 1):
        top = best[end - 1] + p.unknown
        for length, s, i in edges[end]:
            if best[end - length] + s > top:
                top = best[end - length] + s
                size[end], piece[end] = length, i
        best[end] = top
    end, ids = n, []
    while end:
        if piece[end] >= 0:
            ids.append(piece[end])
        else:
            ids.extend(p.byte_ids[list(word[end - 1].encode("utf-8", "surrogatepass"))][::-1].tolist())
        end -= size[end]
    return ids[::-1]


def segment(p: Pieces, words: list[str], cells: int = CELLS) -> dict[str, bytes]:
    """Ids of distinct words as little-endian 32-bit bytes."""
    out: dict[str, bytes] = {}
    by_length: dict[int, list[str]] = {}
    for w in words:
        by_length.setdefault(len(w), []).append(w)
    for n, group in by_length.items():
        if n > LONG_WORD:
            for w in group:
                out[w] = np.array(_long(p, w), "<u4").tobytes()
            continue
        step = max(1, cells // (n + 1))
        for i in range(0, len(group), step):
            part = group[i:i + step]
            out.update(zip(part, _viterbi(p, part)))
    return out


def encode_batch(p: Pieces, texts: list[str | None], known: dict[str, bytes]) -> list[bytes]:
    """Ids of each text as little-endian 32-bit bytes."""
    cut = [_WORD.findall(SPACE + t.replace(" ", SPACE)) if t else [] for t in texts]
    new = {w for ws in cut for w in ws if w not in known}
    if len(known) + len(new) > CACHE_WORDS:
        known.clear()
        new = {w for ws in cut for w in ws}
    known.update(segment(p, list(new)))
    out = [b"".join(map(known.__getitem__, ws)) for ws in cut]
    for w in [w for w in new if len(w) > LONG_WORD]:
        del known[w]
    return out


def decode(p: Pieces, ids: np.ndarray) -> str:
    """The text of a sequence of ids."""
    text = b"".join(map(p.text.__getitem__, ids.tolist())).decode("utf-8", "surrogatepass")
    return text[1:] if text.startswith(" ") else text


@cache
def _remembered(model_path: str) -> dict[str, bytes]:
    """Segmented words of this worker, over all its tasks."""
    return {}


def encode(docs: DataFrame, model_path: str, text_col: str = "text") -> DataFrame:
    """``docs`` with ``ids`` (array of int) and ``n_tokens``; columns of these names are replaced."""
    bounded_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(load(model_path))  # the vocabulary
    docs = docs.select(*[c for c in docs.columns if c not in ("ids", "n_tokens")])
    schema = T.StructType([*docs.schema.fields, *T._parse_datatype_string("ids array<int>, n_tokens long").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p, known = sent.value, _remembered(model_path)
        for b in batches:
            got = encode_batch(p, b.column(b.schema.get_field_index(text_col)).to_pylist(), known)
            n = np.array([len(x) // 4 for x in got], np.int64)
            flat = pa.array(np.frombuffer(b"".join(got), "<i4"), pa.int32())
            ids = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(n))), pa.int32()), flat)
            yield pa.RecordBatch.from_arrays([*b.columns, ids, pa.array(n)], names=[*b.schema.names, "ids", "n_tokens"])

    return docs.mapInArrow(run, schema)


def decoded(tokens: DataFrame, model_path: str, ids_col: str = "ids") -> DataFrame:
    """``tokens`` with ``decoded`` (the text of the ids) and ``ids_crc32`` (of them as 32-bit little-endian)."""
    sent = tokens.sparkSession.sparkContext.broadcast(load(model_path))
    tokens = tokens.select(*[c for c in tokens.columns if c not in ("decoded", "ids_crc32")])
    schema = T.StructType([*tokens.schema.fields, *T._parse_datatype_string("decoded string, ids_crc32 long").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = sent.value
        for b in batches:
            col = b.column(b.schema.get_field_index(ids_col))
            texts, crcs = [], []
            for i in range(len(col)):
                ids = col[i].values.to_numpy(zero_copy_only=False) if col[i].is_valid else np.zeros(0, np.int32)
                texts.append(decode(p, ids))
                crcs.append(zlib.crc32(ids.astype("<u4").tobytes()))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(texts, pa.string()), pa.array(crcs, pa.int64())],
                                             names=[*b.schema.names, "decoded", "ids_crc32"])

    return tokens.mapInArrow(run, schema)
