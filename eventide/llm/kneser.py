"""Interpolated modified Kneser-Ney n-gram model, counted and applied in Spark.

Tokens of a text are its lower-cased words and one end; ``order - 1`` begins
stand before the first. With u a context of one to ``order - 1`` tokens and u'
the same without its leftmost token,

    p(w|u) = max(c(uw) - D(c(uw)), 0) / c(u) + g(u) p(w|u')
    p(w)   = max(k(w) - E(k(w)), 0) / K + e / (V + 1)

In the longest context c counts occurrences in the training texts; in a shorter
one c(uw) is the number of distinct tokens before uw in the training texts, as
k(w) is of w alone. c(u) is the sum of c(uw) over w, K that of k, V the number
of distinct training tokens. Every order has its own three discounts, from the
counts of its counts; g and e are the mass that they free. An unseen context
leaves the shorter one. The unknown token takes the last share of the uniform
part, so every p(.|u) sums to one. Perplexity is 10 ** (-score / n_tokens).

How it runs (text is read once and never shuffled; every message is the
pre-aggregated content of a batch of documents, so a frequent word or n-gram
costs one entry per batch):

1. A task reads documents in batches of ``BATCH_TOKENS`` and deals their
   distinct n-grams, with the batch's documents of each, over shards by the
   hash of v, the token before w: all orders from 2 on, and their contexts, end
   in v or vw and so are whole in one shard. A message holds each of its words
   once and refers to them by place: words that a sample of the corpus shows to
   be common by their number in a broadcast list, others by their hash. Very
   frequent words, and the begin, are dealt by the hash of (v, w). The sample
   places work and sizes messages and changes no result.
2. Each shard counts its n-grams of all orders over all batches. What it shares
   with others (k and c of every w, contexts that end in a frequent v) goes to
   the shard of its hash, which sums and answers.
3. Each shard writes its part of the model as sorted hash arrays to its own
   temporary files, maps them into memory, looks its n-grams up message by
   message and sums the log-probabilities by batch and document; the files go
   when it is done.
4. The sums of a batch's documents are added up.

The model grows with the corpus, and is nowhere held whole: a shard's part is
1 / shards of it. Shards follow ``spark.sql.shuffle.partitions``.

Null text is empty (the end alone). Rows with a null id are scored and not
learned from. Repeated rows are texts of their own. Other columns of the input
are not read. Without training texts all tokens are unknown and score 0, at
perplexity 1. An empty table gives no rows.
"""

from __future__ import annotations

import os
import struct
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide.llm.common import batch_of, bounded_batches, shuffle_partitions, utf8, words_of

BATCH_TOKENS = 2_000_000
#: Words with this share of the sample's tokens are sent by number (at most 1 / COMMON; changes the size of messages alone).
COMMON = 1 / (1 << 20)
#: Longer words are not numbered (bounds the driver's memory).
COMMON_CHARS = 64
#: Share of the rows in the sample that shows frequent words.
SAMPLE = 1 / 64
#: Hashes of strings with a space, which no word has.
BEGIN, END = np.uint64(xxhash.xxh64_intdigest(b" begin")), np.uint64(xxhash.xxh64_intdigest(b" end"))
BLOB, HEADER = 0, 1
_U8, _F8 = np.dtype("<u8"), np.dtype("<f8")


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays as one compressed value; all first bytes of an array, then all second ones, and so on."""
    out = [struct.pack("<I", len(arrays))]
    for a in arrays:
        out.append(struct.pack("<3sQ", a.dtype.str.encode(), len(a)))
        out.append(np.ascontiguousarray(a).view("|u1").reshape(len(a), a.dtype.itemsize).T.tobytes())
    return zstandard.compress(b"".join(out), 1)


def unpack(data: bytes) -> list[np.ndarray]:
    raw = zstandard.decompress(data)
    (n,), at, out = struct.unpack_from("<I", raw), 4, []
    for _ in range(n):
        kind, size = struct.unpack_from("<3sQ", raw, at)
        dtype = np.dtype(kind.decode())
        at += 11
        planes = np.frombuffer(raw, "|u1", size * dtype.itemsize, at).reshape(dtype.itemsize, size)
        out.append(np.ascontiguousarray(planes.T).view(dtype).reshape(size))
        at += size * dtype.itemsize
    return out


def small(a: np.ndarray) -> np.ndarray:
    """Unsigned values in the narrowest type that holds them."""
    top = int(a.max(initial=0))
    return a.astype("|u1" if top < 1 << 8 else "<u2" if top < 1 << 16 else "<u4" if top < 1 << 32 else "<u8")


def gaps(a: np.ndarray) -> np.ndarray:
    """Steps between neighbours, modulo their type; of sorted hashes, their first bytes are small."""
    out = a.copy()
    out[1:] -= a[:-1]
    return out


def from_gaps(a: np.ndarray) -> np.ndarray:
    return np.cumsum(a, dtype=a.dtype)


def pair_hash(v: np.ndarray, w: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = (v ^ (v >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + w * np.uint64(0x94D049BB133111EB)
        h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        return h ^ (h >> np.uint64(31))


def shard_of(h: np.ndarray, shards: int) -> np.ndarray:
    return ((h >> np.uint64(17)) % np.uint64(shards)).astype(np.int64)


def discounts(n: np.ndarray) -> np.ndarray:
    """Discounts of counts 1, 2 and 3 or more from the numbers of counts 1 to 4."""
    if (n[:2] <= 0).any():
        return np.array([0.5, 1.0, 1.5])
    y = n[0] / (n[0] + 2 * n[1])
    d = [1 - 2 * y * n[1] / n[0], 2 - 3 * y * n[2] / n[1], 3 - 4 * y * n[3] / n[2] if n[2] else 1.5]
    return np.clip(d, [0.1, 0.1, 0.1], [1.0, 2.0, 3.0])


def discounted(c: np.ndarray, d: np.ndarray) -> np.ndarray:
    return np.maximum(c - np.where(c >= 3, d[2], np.where(c == 2, d[1], d[0])), 0) * (c > 0)


class HashArray:
    """Sorted hashes with columns of numbers, in files mapped into memory."""

    def __init__(self, folder: str, name: str, keys: np.ndarray, **columns: np.ndarray):
        if (keys[1:] < keys[:-1]).any():
            order = np.argsort(keys)
            keys, columns = keys[order], {k: c[order] for k, c in columns.items()}
        self.keys = self._map(folder, f"{name}-keys", keys)
        self.columns = {k: self._map(folder, f"{name}-{k}", c) for k, c in columns.items()}

    @staticmethod
    def _map(folder: str, name: str, a: np.ndarray) -> np.ndarray:
        if not len(a):
            return a
        path = os.path.join(folder, name)
        np.ascontiguousarray(a).tofile(path)
        return np.memmap(path, a.dtype, "r")

    def at(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place of each key, and whether it is there (place 0 if not)."""
        if not len(self.keys):
            return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
        order = np.argsort(keys)  # in order, as neighbours then lie on the same pages
        i = np.empty(len(keys), np.int64)
        i[order] = np.searchsorted(self.keys, keys[order])
        i[i == len(self.keys)] = 0
        hit = self.keys[i] == keys
        return np.where(hit, i, 0), hit

    def get(self, keys: np.ndarray, *names: str) -> list[np.ndarray]:
        """Columns of the keys; 0 where a key is missing."""
        i, hit = self.at(keys)
        return [np.where(hit, self.columns[n][i], 0) if len(self.keys) else np.zeros(len(keys)) for n in names]


def deal(docs: list[tuple], shards: int, frequent: np.ndarray, batch: int, order: int,
         common: np.ndarray) -> Iterator[tuple[int, int, int, bytes]]:
    """(shard, batch, kind, body) of a batch of (doc_id, trains, held_out, word hashes).

    Words of ``common`` (hashes, frequent ones first) are sent by their place there.
    """
    n_tokens = np.array([len(d[3]) + 1 for d in docs], np.int64)
    tokens = np.concatenate([x for d in docs for x in (d[3], [END])]).astype(np.uint64)
    words, at = np.unique(np.append(tokens, BEGIN), return_inverse=True)
    numbered = np.full(len(words), len(common), np.int64)
    by_hash = np.argsort(common)
    _, of_words, of_common = np.intersect1d(words, common[by_hash], assume_unique=True, return_indices=True)
    numbered[of_words] = by_hash[of_common]
    # common words get low places, which pack well; others follow by hash
    number = np.argsort(numbered, kind="stable")
    new_place = np.empty(len(words), np.int64)
    new_place[number] = np.arange(len(words))
    words, at, numbered = words[number], new_place[at], numbered[number][:len(of_words)]
    doc = np.repeat(np.arange(len(docs)), n_tokens)
    place = np.arange(len(tokens)) + (order - 1) * (doc + 1)
    padded = np.full(len(tokens) + (order - 1) * len(docs), at[-1])
    padded[place] = at[:-1]
    w, v, *left = (padded[place - j] for j in range(order))
    shard = shard_of(words, shards)[v]
    hot = np.isin(words, frequent)[v]
    shard[hot] = shard_of(pair_hash(words[v[hot]], words[w[hot]]), shards)
    key = (shard * len(words) + v) * len(words) + w
    rest = None
    if left:
        rest = words[left[0]]
        for c in left[1:]:
            rest = pair_hash(words[c], rest)
    by = np.argsort(key, kind="stable") if rest is None else np.lexsort((rest, key))  # documents stay in order
    new = np.ones(len(key), bool)
    new[1:] = np.diff(key[by]) != 0
    if rest is not None:
        new[1:] |= np.diff(rest[by]) != 0
    doc = doc[by]
    once = new.copy()
    once[1:] |= np.diff(doc) != 0  # a document counts once per n-gram, with its number of times
    at = np.flatnonzero(once)
    times, doc = np.diff(np.append(at, len(key))), doc[at]
    start = np.flatnonzero(new)
    first = np.append(np.cumsum(once)[start] - 1, len(doc))  # each n-gram's first entry of doc and times
    columns = [c[by[start]] for c in (w, v, *left)]
    bounds = np.searchsorted(shard[by[start]], np.arange(shards + 1))
    trains = np.array([d[1] for d in docs], np.uint8)
    rank = np.zeros(len(words), np.int64)
    for s, (a, b) in enumerate(zip(bounds[:-1], bounds[1:])):
        if a == b:
            continue
        mine = np.zeros(len(words), bool)
        for c in columns:
            mine[c[a:b]] = True
        local = np.flatnonzero(mine)
        rank[local] = np.arange(len(local))
        lw, lv, *others = (rank[c[a:b]] for c in columns)
        cut = np.searchsorted(local, len(numbered))
        yield s, batch, BLOB, pack(trains, small(gaps(numbered[local[:cut]])), gaps(words[local[cut:]]), small(lw),
                                   small(np.diff(lv, prepend=0)), *map(small, others),
                                   small(np.diff(first[a:b + 1])), small(doc[first[a]:first[b]]),
                                   small(times[first[a]:first[b]]))
    ids = np.array([d[0] if d[0] is not None else 0 for d in docs], "<i8")
    yield batch % shards, batch, HEADER, pack(ids, np.array([d[0] is not None for d in docs], np.uint8),
                                              np.array([d[2] for d in docs], np.uint8), small(n_tokens))


class Message:
    """The n-grams that a batch dealt to a shard: hashes of every order and of their contexts."""

    def __init__(self, body: bytes, common: np.ndarray):
        self.trains, numbered, rare, self.w, step, *left, self.per_gram, self.doc, self.times = unpack(body)
        self.words = np.concatenate((common[np.cumsum(numbered, dtype=np.int64)], from_gaps(rare)))
        v = np.cumsum(step, dtype=np.int64)
        self.v = v
        gram, context = self.words[self.w], None
        self.grams, self.contexts = [], []
        for c in (v, *left):
            x = self.words[c]
            gram = pair_hash(x, gram)
            context = x if context is None else pair_hash(x, context)
            self.grams.append(gram)
            self.contexts.append(context)

    def trained(self) -> np.ndarray:
        """Occurrences of each n-gram in training texts."""
        used = self.trains[self.doc].astype(np.int64) * self.times
        return np.add.reduceat(used, np.cumsum(self.per_gram, dtype=np.int64) - self.per_gram)


class Shard:
    """Counts of the n-grams of a shard, from the messages of all batches.

    ``orders`` holds for order 2 and up the n-grams, their counts and contexts;
    ``words`` every w and ``shared`` every context with a frequent v, by order,
    those of held-out texts among them.
    """

    def __init__(self, bodies: list[bytes], order: int, frequent: np.ndarray, common: np.ndarray):
        words, asked, held, shared = [], [], 0, [[] for _ in range(order - 1)]
        grams, contexts, w, c = [], [], [], []
        for body in bodies:
            m = Message(body, common)
            words.append(m.words)
            asked.append(np.bincount(m.w, minlength=len(m.words)) > 0)
            hot = np.isin(m.words, frequent)[m.v]
            for kept, x in zip(shared, m.contexts):
                kept.append(np.unique(x[hot]))
            count = m.trained()
            seen = count > 0
            grams.append(np.stack(m.grams)[:, seen])
            contexts.append(np.stack(m.contexts)[:, seen])
            w.append(m.w[seen].astype(np.int64) + held)
            c.append(count[seen])
            held += len(m.words)
        grams, contexts = np.concatenate(grams, axis=1), np.concatenate(contexts, axis=1)
        words, w, c = np.concatenate(words), np.concatenate(w), np.concatenate(c)
        asked = np.flatnonzero(np.concatenate(asked))
        self.words, at = np.unique(words[asked], return_inverse=True)
        place = np.zeros(held, np.int64)
        place[asked] = at
        w = place[w]
        self.shared = [np.unique(np.concatenate(x)) for x in shared]
        self.word_count = np.bincount(w, weights=c, minlength=len(self.words)).astype(np.int64)
        self.orders = []
        rows = np.arange(len(w))
        for n in reversed(range(order - 1)):
            keys = grams[n][rows]
            by = np.argsort(keys)
            keys = keys[by]
            start = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))[:len(keys)])
            # occurrences in the longest order, then the distinct n-grams one longer
            longest = n == order - 2
            c = np.add.reduceat(c[by], start) if longest and len(c) else np.diff(np.append(start, len(keys)))
            rows = rows[by[start]]
            self.orders.insert(0, (keys[start], c, contexts[n][rows]))
        self.word_before = np.bincount(w[rows], minlength=len(self.words))

    def totals(self) -> list[tuple[np.ndarray, np.ndarray]]:
        """By order: contexts, and for each the sum of its counts and how many are 1, 2, and more."""
        out = []
        for _, c, contexts in self.orders:
            u, at = np.unique(contexts, return_inverse=True)
            out.append((u, np.stack([np.bincount(at, weights=x, minlength=len(u)) for x in (
                c, c == 1, c == 2, c >= 3)], axis=1)))
        return out


def rows_of(keys: np.ndarray, table: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Rows of ``values`` at the sorted ``table``'s places of the keys; zeros where a key is missing."""
    if not len(table):
        return np.zeros((len(keys), values.shape[1]))
    i = np.minimum(np.searchsorted(table, keys), len(table) - 1)
    return np.where((table[i] == keys)[:, None], values[i], 0)


def _counts_of_counts(c: np.ndarray) -> list[float]:
    return [float((c == k).sum()) for k in (1, 2, 3, 4)]


def sampled_words(docs: DataFrame, text_col: str, shards: int, share: float = SAMPLE) -> tuple[np.ndarray, np.ndarray, int]:
    """Hashes and counts of words that are frequent in a sample, the most frequent first, and its number of tokens.

    Words with a quarter of a shard's tokens or with a share of ``COMMON``; at
    most ``4 * shards`` words can hold the one and ``1 / COMMON`` the other.
    """
    words = docs.select(F.col(text_col).alias("t")).sample(share, seed=1).select(
        F.explode(F.split(F.lower("t"), r"[\x20\x09-\x0D]+")).alias("w"))
    counted = words.groupBy("w").count().persist()
    total = counted.agg(F.sum("count")).first()[0] or 0
    top = counted.where((F.col("count") * (4 * shards) >= total) |
                        ((F.col("count") >= total * COMMON) & (F.length("w") <= COMMON_CHARS))).toArrow()
    counted.unpersist()
    hashes = np.array([xxhash.xxh64_intdigest(w) for w in utf8(top.column("w"))], np.uint64)
    count = top.column("count").to_numpy()
    by = np.lexsort((hashes, -count))
    return hashes[by], count[by], total


def frequent_words(hashes: np.ndarray, count: np.ndarray, total: int, shards: int) -> np.ndarray:
    """Hashes of the begin and of words with a quarter of a shard's tokens or more (they only place work), in order."""
    return np.sort(np.append(hashes[count * 4 * shards >= total], BEGIN))


def score(docs: DataFrame, trains, held_out, id_col: str = "doc_id", text_col: str = "text",
          shards: int | None = None, batch_tokens: int = BATCH_TOKENS, order: int = 2) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, perplexity) of every row.

    ``trains`` and ``held_out`` are boolean columns of ``docs`` (null is false);
    ``order`` (2 or more) is the length of the longest n-grams.
    """
    if order < 2:
        raise ValueError("order must be 2 or more")
    spark = docs.sparkSession
    bounded_batches(spark)
    shards = shards or shuffle_partitions(spark)
    hashes, count, total = sampled_words(docs, text_col, shards)
    frequent = frequent_words(hashes, count, total, shards)
    sent = spark.sparkContext.broadcast(np.insert(hashes, 0, BEGIN))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
                       F.coalesce(trains, F.lit(False)).alias("trains"),
                       F.coalesce(held_out, F.lit(False)).alias("held_out"))
    dealt_schema = pa.schema([("shard", pa.int32()), ("batch", pa.int64()), ("kind", pa.int32()), ("body", pa.binary())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq, held, size, common = TaskContext.get().partitionId(), 0, [], 0, sent.value

        def close() -> Iterator[pa.RecordBatch]:
            for r in deal(held, shards, frequent, (part << 32) | seq, order, common):
                yield batch_of(dealt_schema, [[x] for x in r])
        for b in batches:
            for i, text, t, o in zip(b.column(0).to_pylist(), utf8(b.column(1)), b.column(2).to_pylist(),
                                     b.column(3).to_pylist()):
                ws = words_of(text.lower())
                held.append((i, t, o, np.fromiter(map(xxhash.xxh64_intdigest, ws), np.uint64, len(ws))))
                size += len(ws) + 1
                if size >= batch_tokens:
                    yield from close()
                    seq, held, size = seq + 1, [], 0
        if held:
            yield from close()

    dealt = rows.mapInArrow(read, "shard int, batch long, kind int, body binary")

    n_stats = 3 + 4 * order  # V, N, K, then the counts of counts by order
    sent_schema = pa.schema([("home", pa.int32()), ("src", pa.int32()), ("body", pa.binary())])

    def blobs(t: pa.Table) -> list[bytes]:
        return [x for x, k in zip(t.column("body").to_pylist(), t.column("kind").to_pylist()) if k == BLOB]

    def by_home(hashes: np.ndarray) -> list[np.ndarray]:
        home = shard_of(hashes, shards)
        order_ = np.argsort(home, kind="stable")
        bounds = np.searchsorted(home[order_], np.arange(shards + 1))
        return [order_[bounds[s]:bounds[s + 1]] for s in range(shards)]

    def ask(key: tuple, t: pa.Table) -> pa.Table:
        bodies, out, common = blobs(t), [], sent.value
        if bodies:
            me, sh = key[0].as_py(), Shard(bodies, order, frequent, common)
            parts = np.concatenate([rows_of(k, *x) for k, x in zip(sh.shared, sh.totals())]).astype(np.int64)
            contexts = np.concatenate(sh.shared)
            out.append((0, -1 - me, pack(np.array([x for _, c, _ in sh.orders for x in _counts_of_counts(c)], _F8))))
            for s, (at, c) in enumerate(zip(by_home(sh.words), by_home(contexts))):
                if len(at) or len(c):
                    out.append((s, me, pack(gaps(sh.words[at]), small(sh.word_before[at]), small(sh.word_count[at]),
                                            gaps(contexts[c]), *map(small, parts[c].T))))
        return pa.Table.from_batches([batch_of(sent_schema, list(zip(*out)) if out else [[]] * 3)])

    asked = dealt.groupBy("shard").applyInArrow(ask, "home int, src int, body binary")

    answer_schema = pa.schema([("shard", pa.int32()), ("home", pa.int32()), ("body", pa.binary()),
                               ("stats", pa.list_(pa.float64()))])

    def summed(keys: list[np.ndarray], values: list[list[np.ndarray]]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Distinct values summed over equal keys, and the place of every key of each message."""
        _, at = np.unique(np.concatenate(keys), return_inverse=True)
        n = int(at.max(initial=-1)) + 1
        sums = [np.bincount(at, weights=np.concatenate(x), minlength=n).astype(np.int64) for x in zip(*values)]
        return sums, np.split(at, np.cumsum([len(k) for k in keys])[:-1])

    def answer(key: tuple, t: pa.Table) -> pa.Table:
        me = key[0].as_py()
        stats = np.zeros(n_stats)
        got = []
        for src, body in zip(t.column("src").to_pylist(), t.column("body").to_pylist()):
            if src < 0:
                stats[7:] += unpack(body)[0]
            else:
                words, before, count, contexts, *parts = unpack(body)
                got.append((src, from_gaps(words), before, count, from_gaps(contexts), *parts))
        out = []
        if got:
            (before, count), words_at = summed([g[1] for g in got], [g[2:4] for g in got])
            parts, contexts_at = summed([g[4] for g in got], [g[5:] for g in got])
            stats[:3] = [(count > 0).sum(), count.sum(), before.sum()]
            stats[3:7] = _counts_of_counts(before)
            for g, w, c in zip(got, words_at, contexts_at):
                out.append((g[0], me, pack(*(small(x[w]) for x in (before, count)), *(small(x[c]) for x in parts)), None))
        out.append((-1, me, None, stats.tolist()))
        return pa.Table.from_batches([batch_of(answer_schema, list(zip(*out)))])

    answered = asked.groupBy("home").applyInArrow(answer, "shard int, home int, body binary, stats array<double>")
    total = answered.where("shard = -1").agg(F.array(*[F.sum(F.get("stats", i)) for i in range(n_stats)]).alias("stats"))
    replies = answered.where("shard >= 0").unionByName(total.where("stats[0] is not null").select(
        F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), F.lit(-1).alias("home"),
        F.lit(None).cast("binary").alias("body"), "stats"))

    sums_schema = pa.schema([("batch", pa.int64()), ("kind", pa.int32()), ("body", pa.binary()),
                             ("train_tokens", pa.int64())])

    def apply(key: tuple, t: pa.Table, r: pa.Table) -> pa.Table:
        out = [(b, HEADER, x, None) for b, k, x in zip(t.column("batch").to_pylist(), t.column("kind").to_pylist(),
                                                       t.column("body").to_pylist()) if k == HEADER]
        batches = [b for b, k in zip(t.column("batch").to_pylist(), t.column("kind").to_pylist()) if k == BLOB]
        if not batches:
            return pa.Table.from_batches([batch_of(sums_schema, list(zip(*out)) if out else [[]] * 4)])
        bodies, common = blobs(t), sent.value
        sh = Shard(bodies, order, frequent, common)
        stats, replies_ = None, {}
        for home, body, s in zip(r.column("home").to_pylist(), r.column("body").to_pylist(), r.column("stats").to_pylist()):
            if home < 0:
                stats = np.array(s)
            else:
                replies_[home] = unpack(body)
        contexts = np.concatenate(sh.shared)
        before, count, parts = np.zeros(len(sh.words)), np.zeros(len(sh.words)), np.zeros((len(contexts), 4))
        for s, (at, c) in enumerate(zip(by_home(sh.words), by_home(contexts))):
            if s in replies_:
                before[at], count[at], *of_contexts = replies_[s]
                parts[c] = np.stack(of_contexts, axis=1)
        types, tokens, sum_before = stats[:3]
        d = [discounts(stats[3 + 4 * n:7 + 4 * n]) for n in range(order)]
        more = types - stats[3] - stats[4]
        q = np.full(len(sh.words), 1 / (types + 1))
        if sum_before:
            q = discounted(before, d[0]) / sum_before + (d[0] @ [stats[3], stats[4], more]) / sum_before / (types + 1)
        ends = np.cumsum([0, *map(len, sh.shared)])
        with tempfile.TemporaryDirectory() as folder:
            grams, totals = [], []
            for n, ((keys, c, _), (u, own)) in enumerate(zip(sh.orders, sh.totals())):
                grams.append(HashArray(folder, f"grams{n}", keys, c=small(c)))
                local = ~np.isin(u, sh.shared[n])
                u = np.concatenate((u[local], sh.shared[n]))
                own = np.concatenate((own[local], parts[ends[n]:ends[n + 1]]))
                totals.append(HashArray(folder, f"contexts{n}", u, c=small(own[:, 0]), free=own[:, 1:] @ d[n + 1]))
            words = HashArray(folder, "words", sh.words, q=q, count=count)
            del sh, parts, contexts
            for b, body in zip(batches, bodies):
                m = Message(body, common)
                local_q, local_count = words.get(m.words, "q", "count")
                p, wc = local_q[m.w], local_count[m.w]
                for n in range(order - 1):
                    times, = grams[n].get(m.grams[n], "c")
                    kept = discounted(times, d[n + 1])
                    if n:
                        c, free = totals[n].get(m.contexts[n], "c", "free")
                    else:
                        c, free = (x[m.v] for x in totals[0].get(m.words, "c", "free"))
                    known = c > 0
                    c = np.where(known, c, 1)
                    p = np.where(known, kept / c + free / c * p, p)
                base = (wc + 0.5) / (tokens + 0.5 * (types + 1))
                values = np.stack([np.log10(p), np.log10(base), wc > 0])
                values = np.repeat(values, m.per_gram, axis=1) * m.times
                n_docs = len(m.trains)
                out.append((b, BLOB, pack(*[np.bincount(m.doc, weights=x, minlength=n_docs) for x in values[:2]],
                                          small(np.bincount(m.doc, weights=values[2], minlength=n_docs).astype(np.int64))),
                            int(tokens)))
            del grams, totals, words
        return pa.Table.from_batches([batch_of(sums_schema, list(zip(*out)))])

    sums = dealt.groupBy("shard").cogroup(replies.groupBy("shard")).applyInArrow(
        apply, "batch long, kind int, body binary, train_tokens long")
    result_schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()),
                               ("n_known", pa.int64()), ("train_tokens", pa.int64()), ("base_score", pa.float64()),
                               ("score", pa.float64()), ("perplexity", pa.float64())])

    def finish(key: tuple, t: pa.Table) -> pa.Table:
        total, head, trained = None, None, 0
        # in a fixed order, so that equal inputs give equal sums
        for kind, body, n in sorted(zip(*(t.column(c).to_pylist() for c in ("kind", "body", "train_tokens"))),
                                    key=lambda x: (x[0], x[1])):
            if kind == HEADER:
                head = unpack(body)
            else:
                part = np.stack([x.astype(np.float64) for x in unpack(body)])
                total = part if total is None else total + part
                trained = n
        ids, valid, out_, n_tokens = head
        m = len(ids)
        return pa.Table.from_batches([pa.RecordBatch.from_arrays([
            pa.array(ids, pa.int64(), mask=valid == 0), pa.array(out_ > 0), pa.array(n_tokens.astype(np.int64)),
            pa.array(total[2].astype(np.int64)), pa.array(np.full(m, trained)), pa.array(total[1]),
            pa.array(total[0]), pa.array(10 ** (-total[0] / n_tokens))], schema=result_schema)])

    return sums.groupBy("batch").applyInArrow(
        finish, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, "
                "score double, perplexity double")
