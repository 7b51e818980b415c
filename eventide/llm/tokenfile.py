"""Token-id files of directly addressable codes.

A segment holds the ids of consecutive documents. Each id is split into bit
chunks, one level after the other; a level stores its chunks bit-packed, one
continuation bit per chunk (set when the id goes on in the next level) and a
rank directory (set bits before every ``RANK_BITS`` bits), so the id at any
position is read from one chunk per level: position in the next level = rank
of its continuation bit. Level widths are the cheapest for the segment's ids.

Layout of a segment (little-endian): ``MAGIC``, u32 levels, u64 tokens, u64
documents; per level u8 bits, u64 chunks; the documents' ids (i64, with a
validity byte each) and first tokens (u64, one more than documents); then per
level chunks, bitmap, directory (u64). Segments are the ``data`` column of a
Parquet table in the shared folder, uncompressed, so any store Spark can write
to will do; ``part``, ``seq`` order them.

Documents are written in ascending (doc_id, text hash) order, null ids first:
texts are range-partitioned by that key (so a hot id is split) and encoded
where they land. Segments are closed at ``SEGMENT_TOKENS`` ids; a document is
never cut. Null text is empty (the end id only); an empty table gives an empty
file; repeated rows are written as often as they occur.
"""

from __future__ import annotations

import json
import re
import struct
import zlib
from array import array
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eventide.llm.common import bounded_batches, shuffle_partitions
from eventide.llm.pretokens import Units, byte_names, cut_bytes, merged

MAGIC = b"DAC1"
RANK_BITS = 512
SEGMENT_TOKENS = 1 << 20
#: Ids whose bits are packed at a time.
PACK = 1 << 15
#: Encoded words that a worker remembers.
CACHE_WORDS = 1_000_000
MAX_CACHED_CHARS = 64
#: Words without white space inside, of characters whose classes are the same in all Unicode versions in use.
PLAIN = re.compile(r" ?[!-~\u00a1-\u04ff]+")
#: Fixed value: the pre-tokens of byte-level BPE (those of white space left out).
PRE_TOKEN = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+")
#: Texts with these are cut by the rules of :func:`split_words`: what may begin an added token, and white space beyond ASCII.
ODD = r"<\||[\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def widths(ids: np.ndarray) -> list[int]:
    """Chunk widths of the levels with the smallest total size."""
    top = max(1, int(ids.max(initial=0)).bit_length())
    over = [len(ids), *(int(np.count_nonzero(ids >= 1 << b)) for b in range(1, top)), 0]  # ids of more than b bits
    cost: list[tuple[float, int]] = [(0.0, 0)] * (top + 1)
    for b in range(top - 1, -1, -1):
        cost[b] = min((over[b] * (w + (0 if b + w == top else 1 + 64 / RANK_BITS)) + cost[b + w][0], w)
                      for w in range(1, top - b + 1))
    out, b = [], 0
    while b < top:
        out.append(cost[b][1])
        b += cost[b][1]
    return out


def _joined(v: np.ndarray, bits: int) -> np.ndarray:
    """The chunks of each row side by side in one number."""
    out = np.zeros(len(v), np.uint64)
    for k in range(v.shape[1]):
        out = (out << np.uint64(bits)) | v[:, k]
    return out


def _parted(word: np.ndarray, bits: int, out: np.ndarray) -> None:
    """Reverse of :func:`_joined`, into ``out``."""
    for k in reversed(range(out.shape[1])):
        out[:, k] = word & np.uint64((1 << bits) - 1)
        word = word >> np.uint64(bits)


def _be(word: np.ndarray, size: int) -> np.ndarray:
    """The last ``size`` bytes of each number, high byte first."""
    return word.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 8 - size:]


def _from_be(raw: np.ndarray) -> np.ndarray:
    wide = np.zeros((len(raw), 8), np.uint8)
    wide[:, 8 - raw.shape[1]:] = raw
    return wide.view(">u8").reshape(-1).astype(np.uint64)


def _pack(values: np.ndarray, bits: int) -> bytes:
    """Chunks side by side; eight chunks of up to 16 bits fill ``bits`` bytes, in one or two numbers."""
    out = []
    for i in range(0, len(values), PACK):  # PACK is a multiple of 8: only the last slice is padded
        v = values[i:i + PACK]
        if bits > 16:
            v = v.astype(">u4").view(np.uint8).reshape(-1, 4)
            out.append(np.packbits(np.unpackbits(v, axis=1)[:, 32 - bits:].reshape(-1)).tobytes())
            continue
        size = (len(v) * bits + 7) // 8
        v = np.concatenate((v, np.zeros(-len(v) % 8, v.dtype))).reshape(-1, 8)
        if bits <= 8:
            raw = _be(_joined(v, bits), bits)
        else:
            high, low = _joined(v[:, :4], bits), _joined(v[:, 4:], bits)
            over = np.uint64(8 * bits - 64)
            raw = np.hstack((_be((high << np.uint64(64 - 4 * bits)) | (low >> over), 8), _be(low, bits - 8)))
        out.append(raw.tobytes()[:size])
    return b"".join(out)


def _unpack_run(data: np.ndarray, bits: int, a: int, n: int) -> np.ndarray:
    """The ``n`` neighbouring chunks from position ``a`` of a packed level."""
    out = np.empty(n, np.uint32)
    for i in range(0, n, PACK):
        m = min(PACK, n - i)
        if bits > 16:
            first = (a + i) * bits
            flat = np.unpackbits(data[first >> 3:(first + m * bits + 7) >> 3])[first & 7:(first & 7) + m * bits]
            row = np.zeros((m, 32), np.uint8)
            row[:, 32 - bits:] = flat.reshape(m, bits)
            out[i:i + m] = np.packbits(row, axis=1).view(">u4").reshape(-1)
            continue
        skip = (a + i) % 8
        rows = -(-(skip + m) // 8)
        part = data[(a + i) // 8 * bits:][:rows * bits]
        raw = np.concatenate((part, np.zeros(rows * bits - len(part), np.uint8))).reshape(rows, bits)
        got = np.empty((rows, 8), np.uint32)
        if bits <= 8:
            _parted(_from_be(raw), bits, got)
        else:
            first, last = _from_be(raw[:, :8]), _from_be(raw[:, 8:])
            _parted(first >> np.uint64(64 - 4 * bits), bits, got[:, :4])
            # the low four chunks: what the first number has beyond the high four, then the second number
            _parted((first << np.uint64(8 * bits - 64)) | last, bits, got[:, 4:])
        out[i:i + m] = got.reshape(-1)[skip:skip + m]
    return out


def _unpack(data: np.ndarray, bits: int, at: np.ndarray) -> np.ndarray:
    """Chunks at positions ``at`` of a packed level."""
    first = at.astype(np.int64) * bits
    byte = first >> 3
    word = np.zeros(len(at), np.uint64)
    for k in range(5):
        word = (word << np.uint64(8)) | data[np.minimum(byte + k, len(data) - 1)].astype(np.uint64)
    shift = (40 - bits - (first & 7)).astype(np.uint64)
    return (word >> shift) & np.uint64((1 << bits) - 1)


def pack_segment(doc_ids: list[int | None], docs: list[np.ndarray]) -> bytes:
    """Bytes of a segment."""
    ids = np.concatenate(docs).astype(np.uint32) if docs else np.zeros(0, np.uint32)
    levels = widths(ids)
    starts = np.concatenate(([0], np.cumsum([len(d) for d in docs]))).astype("<u8")
    head, body, rest, done = [], [], ids, 0
    for n, bits in enumerate(levels):
        head.append(struct.pack("<BQ", bits, len(rest)))
        body.append(_pack(rest & np.uint32((1 << bits) - 1), bits))
        done += bits
        more = (rest >> np.uint32(bits)) > 0 if bits < 32 else np.zeros(len(rest), bool)
        if n + 1 < len(levels):
            bitmap = np.packbits(more)
            ones = np.add.reduceat(np.bitwise_count(bitmap).astype(np.uint64), np.arange(0, len(bitmap), RANK_BITS // 8)) \
                if len(bitmap) else np.zeros(0, np.uint64)
            body += [bitmap.tobytes(), (np.cumsum(ones) - ones).astype("<u8").tobytes()]
        rest = rest[more] >> np.uint32(bits) if bits < 32 else rest[:0]
    return b"".join([MAGIC, struct.pack("<IQQ", len(levels), len(ids), len(docs)), *head,
                     np.array([x or 0 for x in doc_ids], "<i8").tobytes(),
                     bytes(x is not None for x in doc_ids), starts.tobytes(), *body])


class Segment:
    """A segment read in place: nothing is decoded before it is asked for."""

    def __init__(self, data: bytes):
        if data[:4] != MAGIC:
            raise ValueError("not a token segment")
        n_levels, self.n_tokens, n_docs = struct.unpack_from("<IQQ", data, 4)
        at, shape = 24, []
        for _ in range(n_levels):
            shape.append(struct.unpack_from("<BQ", data, at))
            at += 9
        raw = np.frombuffer(data, np.uint8)
        ids = np.frombuffer(data, "<i8", n_docs, at)
        at += 8 * n_docs
        self.doc_ids = [int(i) if ok else None for i, ok in zip(ids, raw[at:at + n_docs])]
        at += n_docs
        self.starts = np.frombuffer(data, "<u8", n_docs + 1, at).astype(np.int64)
        at += 8 * (n_docs + 1)
        self.levels = []
        for k, (bits, n) in enumerate(shape):
            size = (n * bits + 7) // 8
            chunks = raw[at:at + size]
            at += size
            bitmap = directory = None
            if k + 1 < n_levels:
                size = (n + 7) // 8
                bitmap = raw[at:at + size]
                at += size
                size = -(-n // RANK_BITS)
                directory = np.frombuffer(data, "<u8", size, at).astype(np.int64)
                at += 8 * size
            self.levels.append((bits, chunks, bitmap, directory))

    def _rank(self, bitmap: np.ndarray, directory: np.ndarray, i: int) -> int:
        """Set bits before position i."""
        block = i // RANK_BITS
        if block >= len(directory):
            block = len(directory) - 1
        first = block * (RANK_BITS // 8)
        whole = int(np.bitwise_count(bitmap[first:i >> 3]).sum())
        tail = int(bitmap[i >> 3] >> (8 - (i & 7))).bit_count() if i & 7 else 0
        return int(directory[block]) + whole + tail

    def token(self, i: int) -> int:
        """The id at position i: one chunk of each of its levels."""
        if not 0 <= i < self.n_tokens:
            raise IndexError(i)
        value, shift = 0, 0
        for bits, chunks, bitmap, directory in self.levels:
            value |= int(_unpack(chunks, bits, np.array([i]))[0]) << shift
            shift += bits
            if bitmap is None or not (bitmap[i >> 3] >> (7 - (i & 7))) & 1:
                break
            i = self._rank(bitmap, directory, i)
        return value

    def tokens(self, a: int, b: int) -> np.ndarray:
        """The ids of positions a to b: one rank per level, then neighbouring chunks."""
        out = np.zeros(max(0, b - a), np.uint32)
        where, shift = np.arange(len(out)), 0
        for bits, chunks, bitmap, directory in self.levels:
            if not len(where):
                break
            n = len(where)
            out[where] |= _unpack_run(chunks, bits, a, n) << np.uint32(shift)
            shift += bits
            if bitmap is None:
                break
            bit = np.unpackbits(bitmap[a >> 3:(a + n + 7) >> 3])[a & 7:(a & 7) + n].astype(bool)
            a, where = self._rank(bitmap, directory, a), where[bit]
        return out


def word_parts(word: str, odd: set[str]) -> tuple[str, ...]:
    """Parts of a word that are pre-tokenised apart: around a line feed, and the pre-tokens of plain words.

    Parts that need not be one pre-token are added to ``odd``.
    """
    core = word[1:] if word[:1] == " " else word
    if core.isascii() and core.isalpha():
        return (word,)
    if PLAIN.fullmatch(word):
        return (word,) if core.isalpha() else tuple(PRE_TOKEN.findall(word))
    a, feed, b = word.partition("\n")
    if a and b and "\n" not in b and not a[-1].isspace() and not b[0].isspace():
        odd.add(feed)
        return (*word_parts(a, odd), feed, *word_parts(b, odd))
    odd.add(word)
    return (word,)


def added_tokens(tokenizer) -> re.Pattern | None:
    """Pattern of the added tokens that a text is cut at; None if none is, or if the library has to cut."""
    added = [t for t in tokenizer.get_added_tokens_decoder().values() if not (t.special and tokenizer.encode_special_tokens)]
    # earliest match, then the longest, as the library
    return re.compile("|".join(re.escape(t.content) for t in sorted(added, key=lambda t: -len(t.content)))) if added else None


class _Words(dict):
    """Ids (as bytes) of words; plain pre-tokens go to the model of the tokenizer at once, other words through all of it."""

    def __init__(self, tokenizer):
        super().__init__()
        self.tokenizer = tokenizer
        form = json.loads(tokenizer.pre_tokenizer.__getstate__()) if tokenizer.pre_tokenizer else {}
        self.by_bytes = tokenizer.normalizer is None and form.get("type") == "ByteLevel" and \
            form.get("use_regex") and not form.get("add_prefix_space")
        self.added = added_tokens(tokenizer)
        self.units = Units(tokenizer.model, self._library)
        #: texts are cut at added tokens; those with further rules leave it to the library, which then gets whole texts
        self.plain_added = tokenizer.normalizer is None and not any(
            t.lstrip or t.rstrip or t.single_word for t in tokenizer.get_added_tokens_decoder().values())

    def _library(self, texts: list[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def split(self, text: str) -> list[str]:
        """Words of a text, whose ids joined are the ids of the text; each added token is one."""
        if self.added is None or not self.added.search(text):
            return split_words(text)
        if not self.plain_added:
            return [text]
        out, at = [], 0
        for m in self.added.finditer(text):
            if m.start() > at:
                out += split_words(text[at:m.start()])
            out.append(m[0])
            at = m.end()
        return out + split_words(text[at:]) if at < len(text) else out

    def encode(self, parts: set[str], odd: set[str]) -> dict[str, bytes]:
        """Ids of parts of words."""
        tokenize = self.tokenizer.model.tokenize
        out = {p: array("I", [t.id for t in tokenize(byte_names(p))]).tobytes() for p in parts - odd}
        rest = list(parts & odd)
        out.update(zip(rest, self._library(rest)))
        return out

    def ids(self, texts: list[list[str]]) -> list[list[bytes]]:
        """Ids of the words of each text."""
        if len(self) > CACHE_WORDS:
            self.clear()
        get = self.get
        out = [list(map(get, ws)) for ws in texts]
        missing = {w for ws, r in zip(texts, out) if None in r for w, x in zip(ws, r) if x is None}
        odd: set[str] = set()
        if self.by_bytes:
            whole = {w for w in missing if self.added is not None and self.added.search(w)}
            new = {w: (w,) if w in whole else word_parts(w, odd) for w in missing}
            odd |= whole
        else:
            odd, new = missing, {w: (w,) for w in missing}
        known = self.encode({p for ps in new.values() for p in ps if p not in self}, odd)
        for w, ps in new.items():
            if len(ps) > 1:
                known[w] = b"".join([known.get(p) or self[p] for p in ps])
        for n, ws in enumerate(texts):
            if None in out[n]:
                out[n] = [known[w] if x is None else x for w, x in zip(ws, out[n])]
        self.update((w, x) for w, x in known.items() if len(w) <= MAX_CACHED_CHARS)
        return out


@cache
def _words(definition: str, special_text: bool = True) -> _Words:
    """The words that this worker remembers, over all its tasks."""
    return _Words(_tokenizer(definition, special_text))


@cache
def _tokenizer(definition: str, special_text: bool = True):
    import os
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer
    t = Tokenizer.from_str(definition)
    if special_text:
        t.encode_special_tokens = True  # their strings in a text are ordinary text
    return t


def split_words(text: str) -> list[str]:
    """Cuts before each space that follows another character than a space.

    Byte-level pre-tokens never run from other characters into a space, so the
    ids of the parts are the ids of the text.
    """
    parts = text.split(" ")
    if "" not in parts:
        return [parts[0], *[" " + p for p in parts[1:]]]
    out, lead = [], ""
    for n, p in enumerate(parts):
        lead += " " if n else ""
        if p:
            out.append(lead + p)
            lead = ""
    return [*out, lead] if lead else out


def encode(words: _Words, texts: list[str | None], end: int) -> list[np.ndarray]:
    """Ids of each text, with the end id."""
    cut = [words.split(t) if t else [] for t in texts]
    last = np.array([end], "<u4").tobytes()
    return [np.frombuffer(b"".join([*r, last]), "<u4") for r in words.ids(cut)]


def encode_batch(words: _Words, texts: pa.Array, end: int) -> list[np.ndarray]:
    """As :func:`encode`; texts without odd characters are cut in whole arrays of bytes."""
    texts = texts.fill_null("")
    if not words.by_bytes or not len(texts):
        return encode(words, texts.to_pylist(), end)
    odd = pc.match_substring_regex(texts, ODD)
    ids, bounds = words.units.encode(pc.if_else(odd, "", texts), cut_bytes)
    last = np.array([end], "<u4")
    out = [np.concatenate((ids[a:b], last)) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
    for n in np.flatnonzero(odd.to_numpy(zero_copy_only=False)).tolist():
        out[n] = encode(words, [texts[n].as_py()], end)[0]
    return out


def write(docs: DataFrame, path: str, tokenizer_path: str, end: int, id_col: str = "doc_id", text_col: str = "text",
          segment_tokens: int = SEGMENT_TOKENS, special_text: bool = True) -> None:
    """Encode ``docs`` and write their segments to ``path``.

    ``special_text``: strings of special tokens in a text are ordinary text;
    otherwise they are those tokens, which is the library's default.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    with open(tokenizer_path, encoding="utf-8") as f:
        sent = spark.sparkContext.broadcast(f.read())
    ordered = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64(F.coalesce("text", F.lit("")))]
    ordered = ordered.repartitionByRange(shuffle_partitions(spark), *order).sortWithinPartitions(*order)
    schema = pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("n_tokens", pa.int64()), ("n_docs", pa.int64()),
                        ("data", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _words(sent.value, special_text)
        part, seq = TaskContext.get().partitionId(), 0
        ids: list = []
        held: list[np.ndarray] = []
        size = 0

        def close() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([
                pa.array([part], pa.int32()), pa.array([seq], pa.int32()), pa.array([size], pa.int64()),
                pa.array([len(ids)], pa.int64()), pa.array([pack_segment(ids, held)], pa.binary())], schema=schema)
        for b in merged(batches):
            for i, x in zip(b.column(0).to_pylist(), encode_batch(words, b.column(1), end)):
                ids.append(i)
                held.append(x)
                size += len(x)
                if size >= segment_tokens:
                    yield close()
                    seq, ids, held, size = seq + 1, [], [], 0
        if ids:
            yield close()

    ordered.mapInArrow(run, "part int, seq int, n_tokens long, n_docs long, data binary") \
        .write.option("compression", "none").parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document of the files at ``path``."""
    schema = pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("doc_id", pa.int64()), ("at", pa.int64()),
                        ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part, seq, data in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
                s = Segment(data.as_py())
                n = len(s.doc_ids)
                ids = s.tokens(0, s.n_tokens).astype("<u4").tobytes()
                crc = [zlib.crc32(ids[4 * x:4 * y]) for x, y in zip(s.starts[:-1].tolist(), s.starts[1:].tolist())]
                yield pa.RecordBatch.from_arrays([
                    pa.array([part] * n, pa.int32()), pa.array([seq] * n, pa.int32()), pa.array(s.doc_ids, pa.int64()),
                    pa.array(s.starts[:-1]), pa.array(np.diff(s.starts)), pa.array(crc, pa.int64())], schema=schema)

    files = spark.read.schema("part int, seq int, n_tokens long, n_docs long, data binary").parquet(path)
    docs = files.select("part", "seq", "data").mapInArrow(
        run, "part int, seq int, doc_id long, at long, n_tokens long, ids_crc32 long")
    sizes = files.groupBy("part", "seq").agg(F.sum("n_tokens").alias("n"))
    # ids before a segment: those of earlier parts (a row per part) and of earlier segments of its part
    parts = sizes.groupBy("part").agg(F.sum("n").alias("n")).select(
        "part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    in_part = Window.partitionBy("part").orderBy("seq")
    offsets = sizes.select("part", "seq", (F.sum("n").over(in_part) - F.col("n")).alias("inside")).join(parts, "part")
    return docs.join(offsets, ["part", "seq"]).select(
        "doc_id", (F.col("before") + F.col("inside") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


def lookup(spark: SparkSession, path: str, positions: DataFrame) -> DataFrame:
    """(position, token) of global token ``position``s, each read without decoding its neighbours."""
    files = spark.read.schema("part int, seq int, n_tokens long, n_docs long, data binary").parquet(path)
    sizes = files.select("part", "seq", "n_tokens")
    parts = sizes.groupBy("part").agg(F.sum("n_tokens").alias("n")).select(
        "part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    in_part = Window.partitionBy("part").orderBy("seq")
    offsets = sizes.select("part", "seq", "n_tokens", (F.sum("n_tokens").over(in_part) - F.col("n_tokens")).alias("in"))
    offsets = offsets.join(parts, "part").select("part", "seq", (F.col("before") + F.col("in")).alias("a"),
                                                 (F.col("before") + F.col("in") + F.col("n_tokens")).alias("b"))
    wanted = positions.select(F.col("position").cast("long").alias("position")).join(
        offsets, F.expr("position >= a and position < b")).groupBy("part", "seq").agg(
        F.collect_set(F.struct("position", (F.col("position") - F.col("a")).alias("at"))).alias("wanted"))
    schema = pa.schema([("position", pa.int64()), ("token", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for data, want in zip(b.column(0), b.column(1).to_pylist()):
                s = Segment(data.as_py())
                yield pa.RecordBatch.from_arrays([pa.array([w["position"] for w in want], pa.int64()),
                                                  pa.array([s.token(w["at"]) for w in want], pa.int64())], schema=schema)

    return files.join(wanted, ["part", "seq"]).select("data", "wanted").mapInArrow(run, "position long, token long")
