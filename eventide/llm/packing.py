"""Bounded-space online best-fit packing of token sequences.

Documents are encoded where they lie and cut into pieces of at most
``capacity`` ids; a table of pieces (ids beside their measures) is written to
the shared folder. Packing reads only the measures: pieces are dealt by the
hash of their row key, so each task gets the same mix of lengths, and arrive in
hash order, the longest of each ``RUN`` first. A task keeps ``open_bins`` open sequences in a bitset keyed by free
space: the lowest set bit at or above a piece's length is its best fit; if
there is none, a new sequence opens, and the fullest closes first when too many
are open. A full sequence closes at once. Placements leave as they are made.

The sequences that a task has open at its end, but those too full for any other,
are packed again as whole items, by fullness, in rounds of fewer and fewer groups; each group reads a bounded
number of rows, and the last is one group. Every pass is written before it is
used, and its order is fixed by the rows, so a lost executor repeats the same
placements.

Defined results: null text is empty (the end id only); a null id is kept; rows
that repeat are packed as often as they occur; an empty table gives no rows; only
the id and the text column are read, other columns of any name are ignored. A
text is encoded whole, whatever its length, and only cut if longer than
``capacity``. Which of several equal placements a piece gets depends on how the
input is split over tasks; every result is a gapless packing.
"""

from __future__ import annotations

import json
import re
import uuid
import zlib
from array import array
from collections import defaultdict
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventide.llm.common import bounded_batches, shuffle_partitions
from eventide.llm.pretokens import Units, cut_words, merged
from eventide.session import checkpoint_dir

CAPACITY = 2048
#: Sequences that a task keeps open.
OPEN_BINS = 4096
#: Pieces that arrive together, the longest first.
RUN = 4096
#: Tasks whose open sequences are packed again together.
FAN_IN = 16
#: The normalizer and pre-tokenizer of the word-level BPE file whose words can be encoded apart.
WORD_FORM = {
    "normalizer": {"type": "Sequence", "normalizers": [
        {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pre_tokenizer": {"type": "Sequence", "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"},
         "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]},
}
ADDED = re.compile(r"<\|[^\s]+")


class WordCodes:
    """Encoder of the word-level BPE file; files of another form are left to the library."""

    def __init__(self, definition: str):
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_str(definition)
        form = json.loads(definition)
        #: words between ASCII white space are encoded apart: nothing the file does runs across it, and its added
        #: tokens begin with <| and hold no white space
        self.by_word = all(form.get(k) == v for k, v in WORD_FORM.items()) and form.get("post_processor") is None and not any(
            t["lstrip"] or t["rstrip"] or t["normalized"] or t["single_word"] or not ADDED.fullmatch(t["content"])
            for t in form.get("added_tokens") or [])
        self.units = Units(self.tokenizer.model, self._library)

    def _library(self, texts: list[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts (null: none) joined, and where each text's ids begin (one more than texts)."""
        texts = texts.fill_null("")
        if self.by_word:
            return self.units.encode(texts, cut_words)
        ids = self._library(texts.to_pylist())
        return np.frombuffer(b"".join(ids), "<u4"), np.concatenate(([0], np.cumsum([len(x) // 4 for x in ids], dtype=np.int64)))


@cache
def _codes(definition: str) -> WordCodes:
    """The encoder of this worker, over all its tasks."""
    return WordCodes(definition)


def encode_pieces(docs: DataFrame, tokenizer_path: str, end: int, capacity: int = CAPACITY, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """Pieces of every document: doc_id, piece, start, length, ids_crc32, ids (``<u4``), and a row ``key``."""
    spark = docs.sparkSession
    bounded_batches(spark)
    with open(tokenizer_path, encoding="utf-8") as f:
        sent = spark.sparkContext.broadcast(f.read())
    last = np.array([end], "<u4").tobytes()
    schema = pa.schema([("key", pa.int64()), ("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()),
                        ("length", pa.int64()), ("ids_crc32", pa.int64()), ("ids", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = _codes(sent.value)
        key = TaskContext.get().partitionId() << 40
        for b in merged(batches):
            rows: list[tuple] = []
            ids, bounds = codes.encode(b.column(1))
            data = ids.tobytes()
            for doc, x, y in zip(b.column(0).to_pylist(), bounds[:-1].tolist(), bounds[1:].tolist()):
                ids = data[4 * x:4 * y] + last
                for n, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at:at + 4 * capacity]
                    rows.append((key, doc, n, at // 4, len(part) // 4, zlib.crc32(part), part))
                    key += 1
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    return docs.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(
        run, "key long, doc_id long, piece int, start long, length long, ids_crc32 long, ids binary")


class OpenBins:
    """Open sequences by free space: bit f of ``free`` is set while some open sequence has f free places."""

    def __init__(self, capacity: int, limit: int):
        self.capacity, self.limit, self.free, self.n_open, self.made = capacity, limit, 0, 0, 0
        self.by_free: dict[int, list[int]] = defaultdict(list)

    def _take(self, f: int) -> int:
        found = self.by_free[f]
        b = found.pop()
        if not found:
            self.free &= ~(1 << f)
        self.n_open -= 1
        return b

    def place(self, length: int) -> tuple[int, int]:
        """(sequence, offset) of an item."""
        fits = self.free >> length
        if fits:
            f = length + (fits & -fits).bit_length() - 1
            b = self._take(f)
        else:
            f, b = self.capacity, self.made
            self.made += 1
            if self.n_open == self.limit and length < self.capacity:
                self._take((self.free & -self.free).bit_length() - 1)  # the fullest closes
        if f > length:
            self.by_free[f - length].append(b)
            self.free |= 1 << (f - length)
            self.n_open += 1
        return b, self.capacity - f

    def left(self) -> list[tuple[int, int]]:
        """(sequence, fill) of those open."""
        return [(b, self.capacity - f) for f, found in self.by_free.items() for b in found]


def _pack(items: DataFrame, capacity: int, open_bins: int, level: int) -> DataFrame:
    """(item, bin, offset) of every item (item, size), in the order of the partition; item is null for a
    sequence left open, whose fill is its offset."""
    schema = pa.schema([("item", pa.int64()), ("bin", pa.int64()), ("offset", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins = OpenBins(capacity, open_bins)
        base = (level << 58) | (TaskContext.get().partitionId() << 34)

        def batch(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

        def placed(run: list[tuple]) -> pa.RecordBatch:
            run.sort(key=lambda r: -r[1])  # stable: equal sizes stay in order
            rows = [(item, *bins.place(size)) for item, size in run]
            return batch([(item, base + n, at) for item, n, at in rows])
        held: list[tuple] = []
        for b in batches:
            held += zip(b.column(0).to_pylist(), b.column(1).to_pylist())
            while len(held) >= RUN:
                yield placed(held[:RUN])
                held = held[RUN:]
        if held:
            yield placed(held)
        rows = bins.left()
        if rows:
            yield batch([(None, base + n, fill) for n, fill in rows])

    return items.select("item", "size").mapInArrow(run, "item long, bin long, offset long")


def _written(spark: SparkSession, df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def place(pieces: DataFrame, path: str, capacity: int = CAPACITY, open_bins: int = OPEN_BINS) -> DataFrame:
    """(key, sequence_id, offset) of every piece (key, length); passes are written under ``path``."""
    spark = pieces.sparkSession
    bounded_batches(spark)
    items = pieces.select(F.col("key").alias("item"), F.col("length").alias("size"))
    first = items.repartition(shuffle_partitions(spark), "item").sortWithinPartitions(F.xxhash64("item"), "item")
    packed = _written(spark, _pack(first, capacity, open_bins, 0), f"{path}/0")
    placed = packed.filter(F.col("item").isNotNull()).select(F.col("item").alias("key"), "bin", "offset")
    moved = None  # where the sequences that were open went: (bin, to, base)
    level, groups = 0, 0
    while True:
        left = packed.filter(F.col("item").isNull()).select(F.col("bin").alias("item"), F.col("offset").alias("size"))
        least, n = left.agg(F.min("size"), F.count("size")).first()
        left = left.filter(F.col("size") <= capacity - (least or 0))  # the others cannot take any
        groups = -(-groups // FAN_IN) if groups else max(1, -(-n // (FAN_IN * open_bins)))
        level += 1
        dealt = left.repartition(groups, "item") if groups > 1 else left.repartition(1)
        dealt = dealt.sortWithinPartitions(F.col("size").desc(), "item")
        packed = _written(spark, _pack(dealt, capacity, open_bins, level), f"{path}/{level}")
        step = packed.filter(F.col("item").isNotNull()).select(
            F.col("item").alias("from"), F.col("bin").alias("next"), F.col("offset").alias("more"))
        if moved is None:
            moved = step.select(F.col("from").alias("bin"), F.col("next").alias("to"), F.col("more").alias("base"))
        else:
            moved = moved.join(step, F.col("to") == F.col("from"), "left").select(
                "bin", F.coalesce("next", "to").alias("to"), (F.col("base") + F.coalesce("more", F.lit(0))).alias("base"))
        if groups == 1:
            break
    return placed.join(moved, "bin", "left").select(
        "key", F.coalesce("to", "bin").alias("sequence_id"), (F.col("offset") + F.coalesce("base", F.lit(0))).alias("offset"))


def pack(docs: DataFrame, tokenizer_path: str, end: int, capacity: int = CAPACITY, open_bins: int = OPEN_BINS,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every piece with its ids and its place: doc_id, piece, start, length, ids_crc32, ids, sequence_id, offset."""
    spark = docs.sparkSession
    path = f"{checkpoint_dir(spark)}/packing-{uuid.uuid4().hex}"
    pieces = _written(spark, encode_pieces(docs, tokenizer_path, end, capacity, id_col, text_col), f"{path}/pieces")
    return pieces.join(place(pieces, f"{path}/bins", capacity, open_bins), "key").drop("key")


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, n_tokens, ids) of every sequence: the ids (``<u4``) of its pieces joined in place order.

    A sequence holds at most ``capacity`` ids, so a group is bounded.
    """
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), parts.alias("parts")).select(
        "sequence_id", "n_tokens",
        F.aggregate("parts", F.lit(b"").cast("binary"), lambda done, p: F.concat(done, p["ids"])).alias("ids"))
