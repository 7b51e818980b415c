"""Prefix trie of conversations in minimal-perfect-hash node tables.

A node is a distinct sequence of first turns. Only a digest and the byte length
of each turn leave the scan; turns are range-partitioned by conversation (its
group, where conversations share turns) and streamed in order, so a prefix
digest is the hash of the one before and the next turn. Every ``SHARD_ROWS``
turns, at the end of a conversation, a task closes a shard: its distinct prefix
digests get the slots of a minimal perfect hash (each level keeps the keys that
are alone in their place; a slot's digest is compared on every lookup), and
counts are scattered into flat arrays by slot: parent slot, depth, bytes, members,
smallest member, whether turns follow. Shards are rows of a table in the shared
folder.

A node may lie in many shards. Its member counts are combined by digest and sent
back to the shards; the shard of its smallest member owns it. Each shard adds
what its own nodes contribute into their ancestors through the parent-slot
arrays, deepest first, and the shards' sums are added by digest. So a node that
holds all conversations costs one row per shard, and a prefix that a third of
them share spreads over all shards. Ends of a node leave each shard as one text
of ascending ids and are hashed in shard order, which is id order.

Defined results: rows without a conv_id belong to no conversation; null role or
text is empty; turns are ordered by turn (null first), equal turns by their
digest; repeated rows are repeated turns; an empty table gives no rows; only the
four named columns are read, other columns of any name are ignored. A text of any
length is hashed where it is read. A task holds 24 bytes for each turn of its
longest conversation.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide.llm.common import bounded_batches, shuffle_partitions
from eventide.session import checkpoint_dir

#: Turns of a shard (and its longest conversation).
SHARD_ROWS = 1 << 17
#: Bytes of a digest.
KEY = 16
ROOT = bytes(KEY)
TABLE_DDL = ("shard long, levels binary, keys binary, parent binary, depth binary, bytes binary, n binary, first binary, "
             "inner binary, end_slots binary, ends array<string>")
NODE_SCHEMA = pa.schema([("digest", pa.binary()), ("shard", pa.int64()), ("conv_id", pa.int64()), ("depth", pa.int64()),
                         ("parent_conv_id", pa.int64()), ("n_convs", pa.int64()), ("n_children", pa.int64()),
                         ("n_leaves", pa.int64()), ("saved", pa.int64()), ("ends", pa.string())])
NODE_DDL = ("digest binary, shard long, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, "
            "n_leaves long, saved long, ends string")


@dataclass(frozen=True)
class Fork:
    """Rule by which conversations begin with turns of another: conversation c takes the first h turns of
    c - c mod ``width`` in place of its own first h; h = crc32(decimal c) mod ``modulus``."""
    width: int
    modulus: int

    def shared(self, conv: int) -> int:
        return zlib.crc32(str(conv).encode()) % self.modulus


def _place(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    """Place of each key (two u64) among ``size`` in a level."""
    x = keys[:, 0] ^ (keys[:, 1] * np.uint64(0x9E3779B97F4A7C15)) ^ np.uint64((level * 0xD1B54A32D192ED03) & (2**64 - 1))
    for m in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(m)
    return ((x ^ (x >> np.uint64(31))) % np.uint64(size)).astype(np.int64)


class Slots:
    """Minimal perfect hash: distinct keys to the slots 0 to n-1, with the key of each slot kept to verify lookups."""

    def __init__(self, levels: list[np.ndarray], keys: np.ndarray):
        self.levels, self.keys = levels, keys
        self.ranks, at = [], 0
        for bits in levels:
            self.ranks.append(at + np.cumsum(bits) - bits)
            at += int(bits.sum())

    @classmethod
    def build(cls, keys: np.ndarray) -> Slots:
        """From distinct keys (n x 2 u64)."""
        levels, order, rest = [], [], np.arange(len(keys))
        while len(rest):
            size = max(8, len(rest) * 3 // 2)
            at = _place(keys[rest], len(levels), size)
            alone = np.bincount(at, minlength=size)[at] == 1  # keys that meet others go on to the next level
            bits = np.zeros(size, bool)
            bits[at[alone]] = True
            kept = rest[alone]
            order.append(kept[np.argsort(at[alone])])
            levels.append(bits)
            rest = rest[~alone]
        return cls(levels, keys[np.concatenate(order)] if order else keys)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Slot of each key, -1 for those that have none."""
        out, rest = np.full(len(keys), -1, np.int64), np.arange(len(keys))
        for n, (bits, rank) in enumerate(zip(self.levels, self.ranks)):
            at = _place(keys[rest], n, len(bits))
            hit = bits[at]
            out[rest[hit]] = rank[at[hit]]
            rest = rest[~hit]
        found = np.flatnonzero(out >= 0)
        wrong = (self.keys[out[found]] != keys[found]).any(1)
        out[found[wrong]] = -1
        return out

    def pack(self) -> bytes:
        return b"".join(len(b).to_bytes(8, "little") + np.packbits(b).tobytes() for b in self.levels)

    @classmethod
    def unpack(cls, data: bytes, keys: np.ndarray) -> Slots:
        levels, at = [], 0
        while at < len(data):
            size = int.from_bytes(data[at:at + 8], "little")
            at += 8
            levels.append(np.unpackbits(np.frombuffer(data, np.uint8, (size + 7) // 8, at), count=size).astype(bool))
            at += (size + 7) // 8
        return cls(levels, keys)


def _keys(data: bytes) -> np.ndarray:
    return np.frombuffer(data, "<u8").reshape(-1, 2)


class _Shard:
    """Turns of whole conversations on their way into a node table."""

    def __init__(self):
        self.digests, self.sizes = bytearray(), array("q")
        self.convs, self.lengths = array("q"), array("q")

    def table(self, shard: int) -> tuple:
        """The shard's row: slots of its distinct prefixes and what is counted there."""
        rows, size = _keys(bytes(self.digests)), np.frombuffer(self.sizes, np.int64)
        convs, lengths = np.frombuffer(self.convs, np.int64), np.frombuffer(self.lengths, np.int64)
        ends = np.cumsum(lengths)
        with_root = np.concatenate((_keys(ROOT), rows))
        order = np.lexsort((with_root[:, 1], with_root[:, 0]))
        new = np.ones(len(order), bool)
        new[1:] = (with_root[order[1:]] != with_root[order[:-1]]).any(1)
        slots = Slots.build(with_root[order[new]])
        n_nodes = len(slots.keys)
        root, at = int(slots.find(_keys(ROOT))[0]), slots.find(rows)
        head = np.zeros(len(rows), bool)  # first turns
        head[(ends - lengths)[lengths > 0]] = True
        before = np.concatenate(([root], at[:-1])) if len(at) else at
        before = np.where(head, root, before)
        parent, depth = np.full(n_nodes, -1, np.int32), np.zeros(n_nodes, np.int32)
        weight, n = np.zeros(n_nodes, np.int64), np.bincount(at, minlength=n_nodes).astype(np.int64)
        parent[at] = before
        depth[at] = np.arange(len(rows)) - np.repeat(ends - lengths, lengths) + 1
        weight[at] = size
        first = np.full(n_nodes, np.iinfo(np.int64).max, np.int64)
        np.minimum.at(first, at, np.repeat(convs, lengths))
        inner = np.zeros(n_nodes, bool)
        inner[before] = True
        n[root], first[root] = len(convs), convs.min()
        last = np.full(len(convs), root)
        last[lengths > 0] = at[ends[lengths > 0] - 1]
        by_end = np.argsort(last, kind="stable")  # conversations ascend in a shard
        cut = np.flatnonzero(np.diff(last[by_end])) + 1
        runs = np.split(by_end, cut)
        return (shard, slots.pack(), slots.keys.tobytes(), parent.tobytes(), depth.tobytes(), weight.tobytes(), n.tobytes(),
                first.tobytes(), inner.astype(np.uint8).tobytes(),
                np.array([last[r[0]] for r in runs], np.int32).tobytes(), [",".join(map(str, convs[r].tolist())) for r in runs])


def turn_rows(conversations: DataFrame, width: int = 1) -> DataFrame:
    """(part, conv_id, turn, digest, size) of every turn; ``part`` numbers the conversations' groups of ``width``."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    digest = F.unhex(F.substring(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256), 1, 2 * KEY))
    return conversations.filter(F.col("conv_id").isNotNull()).select(
        F.expr(f"conv_id div {width} - int(conv_id % {width} < 0)").alias("part"), F.col("conv_id").cast("long").alias("conv_id"),
        "turn", digest.alias("digest"), F.octet_length(text).cast("long").alias("size"))


def node_tables(conversations: DataFrame, path: str, fork: Fork | None = None, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """The shards of the trie, written at ``path``; shard numbers ascend with conv_id."""
    spark = conversations.sparkSession
    bounded_batches(spark)
    turns = turn_rows(conversations, fork.width if fork else 1)
    order = ["part", "conv_id", F.col("turn").asc_nulls_first(), "digest"]
    ordered = turns.repartitionByRange(shuffle_partitions(spark), "part").sortWithinPartitions(*order)
    schema = pa.schema([("shard", pa.int64()), *[(c, pa.binary()) for c in (
        "levels", "keys", "parent", "depth", "bytes", "n", "first", "inner", "end_slots")], ("ends", pa.list_(pa.string()))])
    sha = hashlib.sha256

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        group = conv = None
        head: list[tuple[bytes, int]] = []  # (prefix digest, size) of the group's first turns
        is_head, skip, seen, prefix = False, 0, 0, ROOT
        shard, length = _Shard(), 0

        def close() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(shard.table(number), schema)], schema=schema)
        for b in batches:
            for part, c, digest, size in zip(*[b.column(n).to_pylist() for n in range(4)]):
                if c != conv:
                    if conv is not None:
                        shard.convs.append(conv)
                        shard.lengths.append(length)
                        if len(shard.sizes) + len(shard.convs) >= shard_rows:
                            yield close()
                            number, shard = number + 1, _Shard()
                    if part != group:
                        group, head = part, []
                    conv, seen, length, prefix, skip = c, 0, 0, ROOT, 0
                    is_head = fork is not None and c == part * fork.width
                    if fork is not None and not is_head:
                        skip = fork.shared(c)
                        for prefix, n in head[:skip]:
                            shard.digests += prefix
                            shard.sizes.append(n)
                            length += 1
                seen += 1
                if seen > skip:
                    prefix = sha(prefix + digest).digest()[:KEY]
                    shard.digests += prefix
                    shard.sizes.append(size)
                    length += 1
                    if is_head and seen < fork.modulus:
                        head.append((prefix, size))
        if conv is not None:
            shard.convs.append(conv)
            shard.lengths.append(length)
            yield close()

    ordered.select("part", "conv_id", "digest", "size").mapInArrow(run, TABLE_DDL).write.parquet(path)
    return spark.read.schema(TABLE_DDL).parquet(path)


def _members(tables: DataFrame) -> DataFrame:
    """(digest, shard, slot, n, first, inner) of every slot."""
    schema = pa.schema([("digest", pa.binary()), ("shard", pa.int64()), ("slot", pa.int32()), ("n", pa.int64()),
                        ("first", pa.int64()), ("inner", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for shard, keys, n, first, inner in zip(*[b.column(k).to_pylist() for k in range(5)]):
                m = len(keys) // KEY
                yield pa.RecordBatch.from_arrays([
                    _digests(keys), pa.array(np.full(m, shard)), pa.array(np.arange(m, dtype=np.int32)),
                    pa.array(np.frombuffer(n, np.int64)), pa.array(np.frombuffer(first, np.int64)),
                    pa.array(np.frombuffer(inner, np.uint8).astype(np.int32))], schema=schema)

    return tables.select("shard", "keys", "n", "first", "inner").mapInArrow(
        run, "digest binary, shard long, slot int, n long, first long, inner int")


def _digests(keys: bytes) -> pa.Array:
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(KEY), len(keys) // KEY, [None, pa.py_buffer(keys)]).cast(pa.binary())


def _accumulate(table: dict, shard: int, n: np.ndarray, first: np.ndarray, owner: np.ndarray, inner: np.ndarray) -> pa.Table:
    """A shard's part of every sum, from what all shards know of its slots."""
    parent, depth = np.frombuffer(table["parent"], np.int32), np.frombuffer(table["depth"], np.int32)
    own = owner == shard
    leaves = (own & (inner == 0)).astype(np.int64)
    saved = np.where(own, (n - 1) * np.frombuffer(table["bytes"], np.int64), 0)
    children = np.zeros(len(n), np.int64)
    np.add.at(children, parent[own & (depth > 0)], 1)
    by_depth = np.argsort(depth, kind="stable")
    starts = np.searchsorted(depth[by_depth], np.arange(int(depth.max()) + 2))
    for d in range(int(depth.max()), 0, -1):
        at = by_depth[starts[d]:starts[d + 1]]
        np.add.at(leaves, parent[at], leaves[at])
        np.add.at(saved, parent[at], saved[at])
    ends = np.full(len(n), None, object)
    ends[np.frombuffer(table["end_slots"], np.int32)] = table["ends"]
    above = np.where(depth > 0, first[parent], 0)
    some = own | (leaves > 0) | (saved > 0) | (children > 0) | (ends != None)  # noqa: E711 (elementwise)
    cols = [_digests(table["keys"]).filter(pa.array(some)), pa.array(np.full(int(some.sum()), shard))]
    for values, known in ((first, own), (depth.astype(np.int64), own), (above, own & (depth > 0)), (n, own)):
        cols.append(pa.array(values[some], mask=~known[some]))
    cols += [pa.array(children[some]), pa.array(leaves[some]), pa.array(saved[some]), pa.array(ends[some], pa.string())]
    return pa.Table.from_arrays(cols, schema=NODE_SCHEMA)


def nodes(tables: DataFrame) -> DataFrame:
    """Every node of the trie: digest, conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256."""
    bounded_batches(tables.sparkSession)
    members = _members(tables)
    whole = members.groupBy("digest").agg(
        F.sum("n").alias("n"), F.min(F.struct("first", "shard")).alias("least"), F.max("inner").alias("inner"))
    known = members.select("digest", "shard", "slot").join(whole, "digest").select(
        "shard", "slot", "n", F.col("least.first").alias("first"), F.col("least.shard").alias("owner"), "inner")

    def merge(table: pa.Table, known: pa.Table) -> pa.Table:
        if not table.num_rows:
            return NODE_SCHEMA.empty_table()
        t = table.to_pylist()[0]
        order = np.argsort(known.column("slot").to_numpy())
        return _accumulate(t, t["shard"], *[known.column(c).to_numpy()[order] for c in ("n", "first", "owner", "inner")])

    parts = tables.drop("levels", "n", "first", "inner").groupBy("shard").cogroup(known.groupBy("shard")).applyInArrow(merge, NODE_DDL)
    order = ["digest", "shard"]
    return parts.repartition("digest").sortWithinPartitions(*order).mapInArrow(
        _joined, "digest binary, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
                 "saved_tokens long, ends_sha256 string")


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of each digest's rows, and the hash of its ends in shard order, a row at a time."""
    schema = pa.schema([("digest", pa.binary()), *[(c, pa.int64()) for c in (
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")], ("ends_sha256", pa.string())])
    digest = own = sha = None
    sums, any_end = [0, 0, 0], False
    out: list[tuple] = []

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
    for b in batches:
        for key, _, conv, depth, above, n, children, leaves, saved, ends in zip(*[c.to_pylist() for c in b.columns]):
            if key != digest:
                if digest is not None:
                    out.append((digest, *own, *sums, sha.hexdigest()))
                digest, sha, sums, any_end = key, hashlib.sha256(), [0, 0, 0], False
            if n is not None:
                own = (conv, depth, above, n)
            sums[0] += children
            sums[1] += leaves
            sums[2] += saved
            if ends is not None:
                if any_end:
                    sha.update(b",")
                sha.update(ends.encode())
                any_end = True
        if out:
            yield batch()
            out = []
    if digest is not None:
        out.append((digest, *own, *sums, sha.hexdigest()))
        yield batch()


def build(conversations: DataFrame, fork: Fork | None = None, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Nodes of the trie of all conversations (see :func:`nodes`)."""
    path = f"{checkpoint_dir(conversations.sparkSession)}/trie-{uuid.uuid4().hex}"
    return nodes(node_tables(conversations, path, fork, shard_rows))


#: The contract's rule for rebuilt conversations.
FORK = Fork(5, 9)

ORACLE = """
with tbl as (
  select list(v order by i) as l from (
    select i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda a, b: case when a & 1 = 1 then xor(a >> 1, 3988292384) else a >> 1 end) as v
    from (select unnest(range(256)) as i))),
t as (
  select conv_id, coalesce(role, '') as role, coalesce(text, '') as text,
    row_number() over (partition by conv_id order by turn nulls first, role, text) as k
  from conversations where conv_id is not null),
counted as (select conv_id, count(*) as n, cast(conv_id as varchar) as s, conv_id - (conv_id % 5 + 5) % 5 as base from t group by conv_id),
h as (
  select c.conv_id, c.n, c.base, coalesce(b.n, 0) as n_base, xor(list_reduce(
    list_prepend(cast(4294967295 as bigint), list_transform(range(1, strlen(c.s) + 1), lambda i: cast(ascii(substr(c.s, i, 1)) as bigint))),
    lambda a, x: xor(a >> 8, l[(xor(a, x) & 255) + 1])), 4294967295) % 9 as h
  from counted c cross join tbl left join counted b on b.conv_id = c.base),
rebuilt as (
  select h.conv_id, t.k as d, role, text from h join t on t.conv_id = h.base and t.k <= h.h
  union all
  select h.conv_id, least(h.h, h.n_base) + t.k - h.h, role, text from h join t on t.conv_id = h.conv_id and t.k > h.h),
p as (
  select conv_id, d, strlen(text) as size,
    list({'r': role, 't': text}) over (partition by conv_id order by d rows unbounded preceding) as key from rebuilt
  union all select conv_id, 0, 0, [] from h),
len as (select conv_id, max(d) as n from p group by conv_id),
node as (
  select key, any_value(d) as d, any_value(size) as size, count(*) as n, min(conv_id) as conv_id from p group by key),
up as (
  select key as parent, count(*) as n from (select distinct key[1:-2] as parent_key, key as child from node where d > 0) s
  join node on node.key = s.parent_key group by key),
sums as (
  select a.key, sum(case when up.n is null then 1 else 0 end) as n_leaves, sum((x.n - 1) * x.size) as saved
  from node x left join up on up.parent = x.key join p a on a.conv_id = x.conv_id and a.d <= x.d group by a.key),
ends as (
  select key, string_agg(cast(p.conv_id as varchar), ',' order by p.conv_id) as ids
  from p join len on len.conv_id = p.conv_id and len.n = p.d group by key)
select node.conv_id, cast(node.d as bigint) as depth, above.conv_id as parent_conv_id, cast(node.n as bigint) as n_convs,
  cast(coalesce(up.n, 0) as bigint) as n_children, cast(sums.n_leaves as bigint) as n_leaves,
  cast(sums.saved as bigint) as saved_tokens, sha256(coalesce(ends.ids, '')) as ends_sha256
from node join sums using (key) left join up on up.parent = node.key left join ends using (key)
left join node above on node.d > 0 and above.key = node.key[1:-2]
"""
