"""SimHash near-duplicate detection over a byte-position inverted index.

1. Fingerprints: lower-cased words, k-word shingles with repeats, XXH64 (seed
   42) of each; a bit is 1 when set in over half the hashes (Python tasks, one
   pass over the whole texts, no shuffle of text).
2. Equal fingerprints are one node (the smallest doc_id is carried), so groups
   of exact copies cost one row however large they are.
3. Inverted index over byte positions: two fingerprints within d bits share at
   least ``8 - d`` of the 8 positional bytes, hence at least ``p - d`` within
   any p positions. Posting lists are kept for each set of ``p - d`` positions
   out of the first ``p = min(8, d + 3)`` (for d = 4: 35 lists of 24 bits per
   fingerprint), which is where a qualifying pair is guaranteed to meet.
4. Pairs of one list are tallied (shared positional bytes), kept from
   ``8 - d`` upwards and verified by bit distance. No pairs are emitted: a
   list yields a spanning star of each of its linked groups, found by a
   breadth-first walk over the not yet reached fingerprints. A list longer
   than ``LIST_BLOCK`` is dealt in blocks, each pair of blocks a unit of its
   own, so no list is ever held whole by a task, and none is capped.
5. Components by alternating large-star / small-star steps, checkpointed.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventide.llm.common import apart, batch_of, bounded_batches, checkpoint, one_row_per_key, sorted_runs, utf8, words_of

SHINGLE_WORDS = 4
MAX_BITS = 4
#: Components of most rows that are joined by a broadcast.
HEAVY_ROOTS = 1000
SEED = 42
#: Fingerprints of one block of a long posting list.
LIST_BLOCK = 4096
#: Shingle hashes whose bits are counted at a time.
BIT_ROWS = 1 << 15
_FP = pa.schema([("doc_id", pa.int64()), ("fp", pa.int64())])
_EDGE = pa.schema([("u", pa.int64()), ("v", pa.int64())])


def fingerprint(text: bytes, k: int = SHINGLE_WORDS, seed: int = SEED) -> int:
    """64-bit SimHash of a UTF-8 text (0 without words), as an unsigned integer."""
    words = words_of(text.lower())
    n = len(words)
    if not n:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    k = min(k, n)
    digest = xxhash.xxh64_intdigest
    h = np.fromiter((digest(joined[a:b], seed) for a, b in zip(starts[:n - k + 1].tolist(), ends[k - 1:].tolist())),
                    np.uint64, n - k + 1)
    ones = np.zeros(64, np.int64)
    for i in range(0, len(h), BIT_ROWS):
        part = h[i:i + BIT_ROWS].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(h)).view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, fp): one row per input row; null text has no words (fingerprint 0)."""
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.array([fingerprint(t, k) for t in utf8(b.column(1))], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0).cast(pa.int64()), pa.array(fps, pa.int64())], schema=_FP)

    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(run, "doc_id long, fp long")


def _posting_keys(fp: str, d: int) -> Column:
    """The positional-byte keys of a fingerprint: set number, then its bytes."""
    p = min(8, d + 3)
    keys = []
    for n, positions in enumerate(itertools.combinations(range(p), p - d)):
        key = F.lit(n).cast("long")
        for pos in positions:
            byte = F.shiftrightunsigned(F.col(fp), 8 * pos).bitwiseAND(F.lit(255).cast("long"))
            key = F.shiftleft(key, 8).bitwiseOR(byte)
        keys.append(key)
    return F.array(*keys)


def _near(a: np.ndarray, b: np.ndarray, d: int) -> np.ndarray:
    """Tally of shared positional bytes reaching 8 - d, then the bit distance."""
    x = a ^ b
    shared = (np.ascontiguousarray(x).view(np.uint8).reshape(-1, 8) == 0).sum(axis=1)
    out = shared >= 8 - d
    out[out] = np.bitwise_count(x[out]) <= d
    return out


def _walk(fps: np.ndarray, d: int) -> list[tuple[np.ndarray, int]]:
    """Linked groups of distinct fingerprints: (members, root) for groups of two or more."""
    found, rest = [], fps
    while len(rest):
        root, rest = int(rest[0]), rest[1:]
        members, queue = [], [root]
        while queue and len(rest):
            mask = _near(rest, np.uint64(queue.pop()), d)
            if mask.any():
                new = rest[mask]
                members.append(new)
                queue.extend(new.tolist())
                rest = rest[~mask]
        if members:
            found.append((np.concatenate(members), root))
    return found


def _link_lists(d: int, short: int = 16):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, starts in sorted_runs(batches, ["key", "lo", "hi"]):
            fps = t.column("fp").to_numpy().view(np.uint64)
            n = len(fps)
            sizes = np.diff(np.append(starts, n))
            u, v = [], []
            # short lists: every pair of a list, all lists at once
            left = np.repeat(np.where(sizes <= short, sizes, 0), sizes) - (np.arange(n) - np.repeat(starts, sizes)) - 1
            for step in range(1, int(left.max(initial=0)) + 1):
                at = np.flatnonzero(left >= step)
                at = at[_near(fps[at + step], fps[at], d)] if len(at) else at
                u.append(fps[at + step])
                v.append(fps[at])
            for s, m in zip(starts[sizes > short].tolist(), sizes[sizes > short].tolist()):
                for members, root in _walk(np.unique(fps[s:s + m]), d):
                    u.append(members)
                    v.append(np.full(len(members), root, np.uint64))
            if u:
                u, v = np.concatenate(u), np.concatenate(v)
                keep = u != v
                yield batch_of(_EDGE, [u[keep].view(np.int64), v[keep].view(np.int64)])
    return run


def links(nodes: DataFrame, max_bits: int = MAX_BITS, block: int = LIST_BLOCK) -> DataFrame:
    """Edges (u, v) whose components are those of all pairs within ``max_bits``.

    ``nodes`` holds distinct fingerprints in ``fp``.
    """
    if not 0 < max_bits < 8:
        raise ValueError("max_bits must be between 1 and 7")
    index = nodes.select("fp", F.explode(_posting_keys("fp", max_bits)).alias("key"))
    long_lists = index.groupBy("key").count().where(F.col("count") > block)
    blocks = F.ceil(F.col("count") / F.lit(block))
    units = (index.join(long_lists, "key", "left")
             .withColumn("own", F.when(F.col("count").isNull(), F.lit(0).cast("long"))
                         .otherwise(F.pmod(F.xxhash64("fp"), blocks)))
             .withColumn("other", F.explode(F.when(F.col("count").isNull(), F.array(F.lit(0).cast("long")))
                                            .otherwise(F.sequence(F.lit(0).cast("long"), blocks - 1))))
             .select("key", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "fp"))
    units = units.repartition("key", "lo", "hi").sortWithinPartitions("key", "lo", "hi")
    return units.mapInArrow(_link_lists(max_bits), "u long, v long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(u, root): each node of the edges except the roots, with its component's smallest node.

    Alternates large-star and small-star steps; every step is a hash
    aggregation (partial minimum, so hub nodes are combined before the shuffle)
    and an equi-join. Each round is checkpointed to the shared folder.
    """
    e = checkpoint(edges.where("u <> v").select("u", "v"))
    seen = None
    while True:
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(low.select("u", F.col("m").alias("v"))).distinct())
        e = checkpoint(small)
        mark = e.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if not mark[0] or tuple(mark) == seen:
            return e.select("u", F.col("v").alias("root"))
        seen = tuple(mark)


def _components_of(fps: DataFrame, max_bits: int) -> DataFrame:
    """(fp, first_id, root): the distinct fingerprints of ``fps``, the smallest doc_id and the component of each."""
    nodes = fps.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    comp = components(links(nodes.select("fp"), max_bits))
    return nodes.join(comp, F.col("fp") == F.col("u"), "left").select(
        "fp", "first_id", F.coalesce("root", "fp").alias("root"))


def _with_root(rows: DataFrame, table: DataFrame) -> DataFrame:
    """``rows`` joined with ``table`` (one row per root) on ``root``.

    The ``HEAVY_ROOTS`` roots of most rows are joined by a broadcast of that many
    rows of ``table``, so no component of a large share of all rows is dealt to
    one task; each of the others has at most one in ``HEAVY_ROOTS`` of the rows.
    """
    heavy = checkpoint(rows.groupBy("root").count().orderBy(F.col("count").desc(), "root").limit(HEAVY_ROOTS).select("root"))
    known = table.join(F.broadcast(heavy), "root", "left_semi")
    light = rows.join(F.broadcast(heavy), "root", "left_anti").join(table, "root")
    return rows.join(F.broadcast(known), "root").unionByName(light)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = SHINGLE_WORDS,
                    max_bits: int = MAX_BITS) -> DataFrame:
    """(doc_id, fp, component_id) for every input row.

    Null or wordless text: fingerprint 0, linked like any other. Repeated rows
    and equal texts share a component. Null ids keep their row and are ignored
    when the component's smallest id is taken (null when it has no other).
    An empty table gives no rows; further columns are not read.
    """
    fps = checkpoint(fingerprints(docs, id_col, text_col, k))
    rooted = _components_of(fps, max_bits)
    ids = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    by_fp = _with_root(rooted, ids).select("fp", "component_id")
    return fps.join(by_fp, "fp").select("doc_id", "fp", "component_id")


def hex_fingerprint(fp: str) -> Column:
    return F.lpad(F.lower(F.hex(F.col(fp))), 16, "0")


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = SHINGLE_WORDS,
               max_bits: int = MAX_BITS) -> DataFrame:
    """One row of ``docs`` per component: that of the smallest id, then text hash; a row without an id only if none has one.

    Rows are told apart by id and text, so an id that stands for several texts
    loses only those that repeat another row. Equal rows are one. All columns stay as
    they are, whatever their names.
    """
    bounded_batches(docs.sparkSession)
    docs, back = apart(docs, {"no_id", "n", "h", "__no_id", "__n", "__h"} - {id_col, text_col})
    key = [F.col(id_col).isNull().alias("no_id"), F.coalesce(F.col(id_col).cast("long"), F.lit(0).cast("long")).alias("n"),
           F.xxhash64(F.coalesce(F.col(text_col), F.lit("")), F.col(text_col).isNull()).alias("h")]
    names = ["no_id", "n", "h"]
    schema = pa.schema([("no_id", pa.bool_()), ("n", pa.int64()), ("h", pa.int64()), ("fp", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.array([fingerprint(t, k) for t in utf8(b.column(3))], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(fps, pa.int64())], schema=schema)

    rows = checkpoint(docs.select(*key, F.col(text_col)).mapInArrow(run, "no_id boolean, n long, h long, fp long"))
    root = _components_of(rows.select(F.col("n").alias("doc_id"), "fp"), max_bits).select("fp", "root")
    placed = rows.join(root, "fp").select("root", F.struct(*names).alias("key"))
    shared = placed.groupBy("root").agg(F.min("key").alias("first"), F.max("key").alias("last")).where("first <> last")
    more = _with_root(placed, shared).where("key <> first").select("key.*").distinct()
    keyed = docs.withColumns({f"__{n}": c for n, c in zip(names, key)})
    mine = [f"__{n}" for n in names]
    left = keyed.join(more, [F.col(m) == F.col(n) for m, n in zip(mine, names)], "left_anti")
    return one_row_per_key(left, mine, rows.groupBy(*names).count().where("count > 1").select(*names)).select(*back)
