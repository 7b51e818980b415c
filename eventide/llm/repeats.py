"""Substring dedup by seed and extend over winnowed anchors.

A repeat is a sequence of ``WINDOW`` words that starts in more than one place.

1. Seeds: every ``ANCHOR_WORDS``-word sequence is hashed and winnowed: of each
   window the smallest of its anchors is its anchor, so equal windows have
   equal anchors. Documents are joined on anchors: those met in one place only
   seed nothing (one shuffle of about 2 rows per ``WINDOW - ANCHOR_WORDS``
   words).
2. Extension: around every remaining seed the match is extended both ways by
   all windows that have the seed as their anchor; a window goes on when the
   same words stand around the seed elsewhere (96-bit hashes of whole windows,
   one shuffle).
3. Windows that go on are merged into maximal repeats per document.

Hot groups: what a batch of documents holds twice is settled in the batch and
sent on as intervals with one representative, so a sequence that stands in a
third of all documents costs a row per batch. No pairs are made.

Null text has no words. Rows repeating a doc_id are documents of their own
(told apart by their text); equal rows repeat each other. Texts shorter than a
window keep all words. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide.llm.common import batch_of, bounded_batches, sorted_runs, utf8, words_of

WINDOW = 35
ANCHOR_WORDS = 8
NO_ID = -(1 << 63)
_M1, _M2 = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F
SINGLE, KNOWN, SHARED = 0, 1, 2  # one window; an interval known to repeat; a window that a batch holds more than once
_ROWS = pa.schema([("kind", pa.int64()), ("h", pa.int64()), ("g", pa.int64()), ("i", pa.int64()), ("row", pa.int64())])
_ROWS_SQL = "kind long, h long, g long, i long, row long"
_HITS = pa.schema([("row", pa.int64()), ("i", pa.int64()), ("n", pa.int64())])


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def window_hash(h: np.ndarray, length: int, factor: int) -> np.ndarray:
    """Polynomial hash of every ``length`` neighbouring values, by doubling."""
    with np.errstate(over="ignore"):
        out, done = None, 0
        part, size = h, 1
        while size <= length:
            if length & size:
                out = part if out is None else out[:len(h) - done - size + 1] * np.uint64(pow(factor, size, 1 << 64)) \
                    + part[done:]
                done += size
            part = part[:-size] * np.uint64(pow(factor, size, 1 << 64)) + part[size:] if len(part) > size else part[:0]
            size *= 2
        out = out[:max(0, len(h) - length + 1)]
        out = (out ^ (out >> np.uint64(31))) * np.uint64(_M2)
        return out ^ (out >> np.uint64(30))


def sliding_min(x: np.ndarray, length: int) -> np.ndarray:
    """Minimum of every ``length`` neighbouring values."""
    size = 1
    while size * 2 <= length:
        x = np.minimum(x[:-size], x[size:])
        size *= 2
    return np.minimum(x[:len(x) - (length - size)], x[length - size:]) if length > size else x


def anchors(words: list[bytes], window: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes, anchor hashes, and the anchor of every window."""
    h = word_hashes(words)
    if len(words) < window:
        return h, h[:0], h[:0]
    a = window_hash(h, k, _M1)
    return h, a, sliding_min(a, window - k + 1)


def _emit(h: np.ndarray, g: np.ndarray, i: np.ndarray, row: np.ndarray) -> pa.RecordBatch:
    """Rows for the shuffle: what occurs twice here becomes known intervals and one representative."""
    n = len(h)
    order = np.lexsort((g, h))
    hs, gs = h[order], g[order]
    new = np.ones(n, bool)
    new[1:] = (hs[1:] != hs[:-1]) | (gs[1:] != gs[:-1])
    start = np.flatnonzero(new)
    size = np.diff(np.append(start, n))
    once = order[start[size == 1]]
    reps = order[start[size > 1]]
    known = np.sort(order[np.repeat(size > 1, size)])  # in document order: neighbours are merged
    ki, kr = i[known], row[known]
    first = np.ones(len(known), bool)
    first[1:] = (kr[1:] != kr[:-1]) | (ki[1:] != ki[:-1] + 1)
    at = np.flatnonzero(first)
    length = np.diff(np.append(at, len(known)))
    with np.errstate(over="ignore"):
        spread = (kr[at].astype(np.uint64) * np.uint64(_M1) ^ ki[at].astype(np.uint64) * np.uint64(_M2)).view(np.int64)
    return batch_of(_ROWS, [
        np.concatenate((np.full(len(once), SINGLE), np.full(len(reps), SHARED), np.full(len(at), KNOWN))),
        np.concatenate((h[once].view(np.int64), h[reps].view(np.int64), spread)),
        np.concatenate((g[once], g[reps], length)),
        np.concatenate((i[once], i[reps], ki[at])),
        np.concatenate((row[once], row[reps], kr[at]))])


def _repeated(rows: DataFrame) -> DataFrame:
    """(row, i, n): the intervals of rows whose (h, g) occurs more than once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, starts in sorted_runs(batches, ["h", "g"]):
            kind, i, row, g = (t.column(c).to_numpy() for c in ("kind", "i", "row", "g"))
            count = np.add.reduceat((kind != KNOWN).astype(np.int64), starts)
            more = np.repeat(count > 1, np.diff(np.append(starts, len(kind))))
            hit = ((kind == SINGLE) & more) | (kind == KNOWN)
            yield batch_of(_HITS, [row[hit], i[hit], np.where(kind[hit] == KNOWN, g[hit], 1)])

    return rows.repartition("h").sortWithinPartitions("h", "g").mapInArrow(run, "row long, i long, n long")


def _seeds(base: DataFrame, window: int, k: int) -> DataFrame:
    """(row, anchors): the anchors of a document that occur more than once anywhere."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            hs, rows = [], []
            for row, text in zip(b.column(0).to_pylist(), utf8(b.column(1))):
                _, a, of_window = anchors(words_of(text), window, k)
                if len(of_window):
                    chosen = a[np.isin(a, np.unique(of_window))]
                    hs.append(chosen)
                    rows.append(np.full(len(chosen), row, np.int64))
            if hs:
                h = np.concatenate(hs)
                # the anchor itself is what is handed on, so it stands in i and intervals stay single
                yield _emit_anchors(h, np.concatenate(rows))

    found = _repeated(base.mapInArrow(run, _ROWS_SQL))
    return found.groupBy("row").agg(F.collect_set("i").alias("anchors"))


def _emit_anchors(h: np.ndarray, row: np.ndarray) -> pa.RecordBatch:
    value, inverse, count = np.unique(h, return_inverse=True, return_counts=True)
    several = count[inverse] > 1
    pairs = np.unique(np.stack([row[several].view(np.uint64), h[several]], axis=1), axis=0)  # once per document
    shared = value[count > 1]
    with np.errstate(over="ignore"):
        spread = (pairs[:, 0] * np.uint64(_M1) ^ pairs[:, 1]).view(np.int64)
    single = ~several
    n, m, s = int(single.sum()), len(shared), len(pairs)
    return batch_of(_ROWS, [
        np.repeat([SINGLE, SHARED, KNOWN], [n, m, s]),
        np.concatenate((h[single].view(np.int64), shared.view(np.int64), spread)),
        np.concatenate((np.zeros(n + m, np.int64), np.ones(s, np.int64))),
        np.concatenate((h[single].view(np.int64), shared.view(np.int64), pairs[:, 1].view(np.int64))),
        np.concatenate((row[single], np.zeros(m, np.int64), pairs[:, 0].view(np.int64)))])


def _windows(seeded: DataFrame, window: int, k: int) -> DataFrame:
    """Windows whose anchor is a seed, as rows for _repeated."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            hs, gs, i_, rows = [], [], [], []
            for row, text, seeds in zip(b.column(0).to_pylist(), utf8(b.column(1)), b.column(2)):
                h, _, of_window = anchors(words_of(text), window, k)
                at = np.flatnonzero(np.isin(of_window, seeds.values.to_numpy().view(np.uint64)))
                if len(at):
                    hs.append(window_hash(h, window, _M1)[at])
                    gs.append((window_hash(h, window, _M2)[at] >> np.uint64(32)).astype(np.int64))
                    i_.append(at)
                    rows.append(np.full(len(at), row, np.int64))
            if hs:
                yield _emit(*(np.concatenate(x) for x in (hs, gs, i_, rows)))

    return seeded.mapInArrow(run, _ROWS_SQL)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                   k: int = ANCHOR_WORDS) -> DataFrame:
    """(doc_id, n_words, n_removed, kept, spans): every row's words that no repeat covers, and its repeats.

    ``kept`` joins the words left by one space; ``spans`` are the maximal
    repeats in words, (start, end) with the end exclusive.
    """
    bounded_batches(docs.sparkSession)
    base = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("id"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    twice = base.groupBy("id").count().where("count > 1")
    row = F.col("id") if twice.isEmpty() else F.xxhash64("id", "text")
    base = base.select(row.alias("row"), "id", "text")
    seeds = _seeds(base.select("row", "text"), window, k)
    seeded = base.join(seeds, "row").select("row", "text", "anchors", "id")
    hits = _repeated(_windows(seeded, window, k)).groupBy("row").agg(
        F.collect_set(F.shiftleft(F.col("i"), 32).bitwiseOR(F.col("n"))).alias("hits"))
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()),
                        ("kept", pa.string()), ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for i, text, hit in zip(b.column(0).to_pylist(), utf8(b.column(1)), b.column(2)):
                words = words_of(text)
                i = None if i == NO_ID else i
                if not hit.is_valid:
                    out.append((i, len(words), 0, b" ".join(words).decode(), []))
                    continue
                x = hit.values.to_numpy()
                first, n = x >> 32, x & 0xFFFFFFFF
                edge = np.zeros(len(words) + 1, np.int64)
                np.add.at(edge, first, 1)
                np.add.at(edge, first + n + window - 1, -1)
                gone = np.cumsum(edge[:-1]) > 0
                turn = np.flatnonzero(np.diff(np.concatenate(([0], gone.astype(np.int8), [0]))))
                spans = [{"start": int(a), "end": int(e)} for a, e in zip(turn[::2], turn[1::2])]
                kept = [w for w, g in zip(words, gone.tolist()) if not g]
                out.append((i, len(words), len(words) - len(kept), b" ".join(kept).decode(), spans))
            yield batch_of(schema, list(zip(*out)) if out else [[]] * 5)

    return base.join(hits, "row", "left").select("id", "text", "hits").mapInArrow(
        run, "doc_id long, n_words long, n_removed long, kept string, spans array<struct<start:long,end:long>>")


ORACLE = """
WITH d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
g AS (
  SELECT doc_id, i, md5(array_to_string(w[i:i + 34], ' ')) AS h
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS i FROM d)),
r AS (SELECT h FROM g GROUP BY h HAVING count(*) > 1),
c AS (SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS k FROM g SEMI JOIN r USING (h)),
s AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS k FROM d),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY k) AS text, count(*) AS n
  FROM s ANTI JOIN c USING (doc_id, k) GROUP BY doc_id)
SELECT d.doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""

