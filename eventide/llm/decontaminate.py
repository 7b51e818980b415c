"""Benchmark decontamination with a BM25 block-max index of the test items.

The index holds the test items; the training passages are the queries.

* Impacts are BM25 weights divided by the item's own score, so a passage that
  holds all terms of an item scores 1 whatever the item's length. Document
  frequencies and lengths cover the whole benchmark.
* A document is read in passages of twice the longest item (at least
  ``PASSAGE`` words) that overlap by half, so any item lies whole in one.
* Pruning is exact. Terms too common to carry a match (their summed impact
  stays under half the threshold in every item) are the non-essential lists;
  the essential lists are traversed by block, adding block maxima, and a block
  is opened only when its bound plus its non-essential maximum reaches the
  threshold. Items of opened blocks are scored in full; all items reaching the
  threshold are retrieved.
* Verification: the item's question (all but its last sentence) and answer
  (its last sentence; of a single sentence, its last quarter) are aligned to
  the passage. Both must overlap by ``MIN_OVERLAP`` of their words in common
  runs of ``RUN_WORDS`` words or more, or the item must lie there as a lightly
  edited copy: aligned as a whole, word by word in order, with ``RUN_WORDS``
  words in a row, question and answer each miss at most ``1 - MIN_OVERLAP`` of
  their words (one word in short ones), and the item misses no more than that
  in all. A part of one word may only be missed if nothing of the other is; in
  place of an answer another word must stand.

The benchmark is read in shards of about ``SHARD_ITEMS`` items, each small enough
to send to every task; all documents are run against every shard. Documents are
not shuffled. Null texts have no words; items without words match nothing;
item rows that repeat (same id and text) are one item, an id with several texts
or none stands for an item of each text; an empty benchmark or table gives no rows.
"""

from __future__ import annotations

import itertools
import re
import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from difflib import SequenceMatcher

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventide.llm.common import apart, bounded_batches
from eventide.session import checkpoint_dir
from eventide.sources.folders import delete

K1, B = 1.2, 0.75
THRESHOLD = 0.6
MIN_OVERLAP = 0.8
RUN_WORDS = 3
#: Cost of a passage word skipped inside an aligned copy (a common word earns 1).
SKIP = 0.5
PASSAGE = 128
BLOCK = 16
SHARD_ITEMS = 20_000

_WORD = re.compile(r"\w+")


def words(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def question_answer(text: str) -> tuple[list[str], list[str]]:
    """Words of the question and of the answer of an item."""
    sentences = [w for w in (words(s) for s in re.split(r"(?<=[.?!])\s+", text)) if w]
    if len(sentences) > 1:
        return [w for s in sentences[:-1] for w in s], sentences[-1]
    w = sentences[0] if sentences else []
    cut = len(w) - max(1, len(w) // 4)
    return w[:cut], w[cut:]


def overlap(part: list[str], passage: list[str], run: int = RUN_WORDS) -> float:
    """Share of ``part`` in common runs with the passage (1 for an empty part)."""
    if not part:
        return 1.0
    blocks = SequenceMatcher(None, part, passage, autojunk=False).get_matching_blocks()
    return sum(b.size for b in blocks if b.size >= min(run, len(part))) / len(part)


def align(item: list[str], passage: list[str]) -> tuple[list[int], int]:
    """Item positions aligned to equal passage words, in order, and the first passage word after them.

    The alignment is the one with most common words less ``SKIP`` for each
    passage word skipped between them; item words are left out at no cost.
    """
    n = len(passage)
    best = [0.0] * (n + 1)  # best alignment of the item so far that ends before a passage position
    rows = []
    for w in item:
        # per position: 0 as without this word, 1 aligned to it, 2 the passage word is skipped
        new, how = [best[0]], [0]
        for j, p in enumerate(passage, 1):
            x, k = best[j], 0
            if p == w and best[j - 1] + 1 >= x:
                x, k = best[j - 1] + 1, 1
            if new[-1] - SKIP > x:
                x, k = new[-1] - SKIP, 2
            new.append(x)
            how.append(k)
        rows.append(how)
        best = new
    j = end = max(range(n + 1), key=best.__getitem__)
    i, out = len(item), []
    while i:
        k = rows[i - 1][j]
        if k == 1:
            out.append(i - 1)
        i, j = i - (k != 2), j - (k != 0)
    return out[::-1], end


def edited_copy(question: list[str], answer: list[str], passage: list[str]) -> tuple[float, float] | None:
    """Aligned shares of question and answer if the item lies in the passage as a lightly edited copy."""
    words_in = Counter(passage)

    def most(n: int) -> int:
        return max(1, int(n * (1 - MIN_OVERLAP) + 1e-9))
    # no alignment has more common words than the bags
    for part in (question, answer):
        if len(part) - (Counter(part) & words_in).total() > most(len(part)):
            return None
    hits, end = align(question + answer, passage)
    cut = len(question)
    q = sum(h < cut for h in hits)
    a = len(hits) - q
    run = longest = 0
    for before, h in zip([None, *hits], hits):
        run = run + 1 if before is not None and h == before + 1 else 1
        longest = max(longest, run)
    missed = cut + len(answer) - len(hits)
    if cut - q > most(cut) or len(answer) - a > most(len(answer)) or missed > most(cut + len(answer)) \
            or longest < min(RUN_WORDS, cut + len(answer)):
        return None
    if cut and not q and a < len(answer) or answer and not a and (q < cut or end >= len(passage)):
        return None
    return q / max(cut, 1), a / max(len(answer), 1)


@dataclass
class Index:
    ids: list[int | None]
    parts: list[tuple[list[str], list[str]]]
    vocabulary: dict[str, int]
    start: np.ndarray  # postings of a term: start[t]:start[t+1], by item
    item: np.ndarray
    impact: np.ndarray
    essential: np.ndarray  # by term
    block_start: np.ndarray  # (block, maximum) lists of a term
    block: np.ndarray
    block_max: np.ndarray
    rest_max: np.ndarray  # by block: largest summed non-essential impact of an item
    passage: int
    threshold: float


def build(rows: list[tuple[int | None, str]], df: dict[str, int], n_items: int, avg_len: float,
          longest: int = 0,
          threshold: float = THRESHOLD) -> Index:
    """Index of one shard of items; ``longest``: words of the longest item of all shards."""
    ids = [r[0] for r in rows]
    tokens = [words(r[1]) for r in rows]
    longest = max([longest, *map(len, tokens)])
    vocabulary: dict[str, int] = {}
    t_, i_, w_ = [], [], []
    for i, ws in enumerate(tokens):
        tf: dict[str, int] = {}
        for w in ws:
            tf[w] = tf.get(w, 0) + 1
        weight = {w: np.log(1 + (n_items - df[w] + 0.5) / (df[w] + 0.5)) * c * (K1 + 1)
                  / (c + K1 * (1 - B + B * len(ws) / avg_len)) for w, c in tf.items()}
        own = sum(weight.values())
        for w, x in weight.items():
            t_.append(vocabulary.setdefault(w, len(vocabulary)))
            i_.append(i)
            w_.append(x / own)
    t, item, impact = np.array(t_, np.int64), np.array(i_, np.int64), np.array(w_, np.float64)
    order = np.lexsort((item, t))
    t, item, impact = t[order], item[order], impact[order]
    n_terms = len(vocabulary)
    start = np.searchsorted(t, np.arange(n_terms + 1))
    # non-essential terms: the most frequent ones, while no item's sum exceeds half the threshold
    rest = np.zeros(len(ids))
    essential = np.ones(n_terms, bool)
    for term in np.argsort(-np.array([df[w] for w in vocabulary], np.int64), kind="stable"):
        s = slice(start[term], start[term + 1])
        after = rest[item[s]] + impact[s]
        if (after > threshold / 2).any():
            break
        rest[item[s]] = after
        essential[term] = False
    n_blocks = (len(ids) + BLOCK - 1) // BLOCK
    key = t * max(n_blocks, 1) + item // BLOCK
    first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.zeros(0, np.int64)
    block_max = np.maximum.reduceat(impact, first) if len(first) else impact
    rest_max = np.zeros(n_blocks)
    np.maximum.at(rest_max, np.arange(len(ids)) // BLOCK, rest)
    return Index(ids, [question_answer(r[1]) for r in rows], vocabulary, start, item, impact, essential,
                 np.searchsorted(t[first], np.arange(n_terms + 1)), item[first] // BLOCK, block_max, rest_max,
                 max(PASSAGE, 2 * longest), threshold)


def _ranges(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All positions of the given ranges, and the range of each."""
    size = ends - starts
    which = np.repeat(np.arange(len(size)), size)
    return np.arange(len(which)) - np.repeat(np.cumsum(size) - size, size) + np.repeat(starts, size), which


def retrieve(ix: Index, terms: np.ndarray) -> list[tuple[int, int, float]]:
    """(first word of the passage, item, score) of all passages and items reaching the threshold.

    ``terms``: the term of each word of one text (or of several, kept apart by
    gaps), -1 outside the vocabulary.
    """
    half = ix.passage // 2
    n_blocks = len(ix.rest_max)
    at = np.flatnonzero(terms >= 0)
    at = at[ix.essential[terms[at]]]
    if not len(at):
        return []
    # a word lies in the passage starting at its half-passage and in the one before
    cell = np.concatenate((at // half, at // half - 1))
    term = np.tile(terms[at], 2)
    pair = np.unique((cell + 1) * len(ix.vocabulary) + term)
    cell, term = pair // len(ix.vocabulary) - 1, pair % len(ix.vocabulary)
    cell, term = cell[cell >= 0], term[cell >= 0]
    pos, which = _ranges(ix.block_start[term], ix.block_start[term + 1])
    key, inverse = np.unique(cell[which] * n_blocks + ix.block[pos], return_inverse=True)
    bound = np.bincount(inverse, weights=ix.block_max[pos])
    opened = key[bound + ix.rest_max[key % n_blocks] >= ix.threshold - 1e-9]
    out = []
    for c, group in itertools.groupby(opened.tolist(), key=lambda k: k // n_blocks):
        blocks = np.array([k % n_blocks for k in group])
        span = terms[c * half:c * half + ix.passage]
        term = np.unique(span[span >= 0])
        pos, _ = _ranges(ix.start[term], ix.start[term + 1])
        pos = pos[np.isin(ix.item[pos] // BLOCK, blocks)]
        items, inverse = np.unique(ix.item[pos], return_inverse=True)
        scores = np.bincount(inverse, weights=ix.impact[pos])
        out += [(c * half, int(i), float(s)) for i, s in zip(items, scores) if s >= ix.threshold - 1e-9]
    return out


def matches(ix: Index, texts: list[str | None]) -> list[list[tuple[int | None, float, float, float]]]:
    """(item id, score, question overlap, answer overlap) of each text, one per item, null ids first, then by id."""
    tokens = [words(t) for t in texts]
    get = ix.vocabulary.get
    out: list[list] = [[] for _ in texts]
    # texts are laid out one after another with gaps of two passages
    gap = 2 * ix.passage
    at, parts, places = 0, [], []
    for w in tokens:
        places.append(at)
        parts.append(np.fromiter((get(x, -1) for x in w), np.int64, len(w)))
        pad = gap + (-(len(w) + gap)) % (ix.passage // 2 or 1)
        parts.append(np.full(pad, -1, np.int64))
        at += len(w) + pad
    found: dict[tuple[int, int], tuple] = {}
    for begin, i, score in retrieve(ix, np.concatenate(parts) if parts else np.zeros(0, np.int64)):
        d = int(np.searchsorted(places, begin, side="right")) - 1
        passage = tokens[d][begin - places[d]:begin - places[d] + ix.passage]
        q, a = (overlap(p, passage) for p in ix.parts[i])
        if q < MIN_OVERLAP or a < MIN_OVERLAP:
            copy = edited_copy(*ix.parts[i], passage)
            if copy is None:
                continue
            q, a = max(q, copy[0]), max(a, copy[1])
        if found.get((d, i), (0.0,))[0] < score:
            found[d, i] = (score, q, a)
    for (d, i), (score, q, a) in sorted(found.items()):  # items are in id order
        out[d].append((ix.ids[i], round(score, 6), round(q, 6), round(a, 6)))
    return out


def item_words(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, text, words) of the distinct items (id and text), words as they are matched."""
    rows = items.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).where(
        "text is not null").distinct()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array([words(t) for t in b.column(1).to_pylist()], pa.list_(pa.string()))],
                                             names=["id", "text", "words"])
    return rows.mapInArrow(run, "id long, text string, words array<string>")


def shards(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> Iterator[Index]:
    """Indexes of the benchmark, about ``SHARD_ITEMS`` items each, in id and text order, null ids first.

    Items are dealt to shards by the hash of id and text, in one pass that
    writes them by shard; a shard is read from its own folder. Document
    frequencies, lengths and the passage length are those of all items, counted
    over the words that matching uses, so no result depends on the number of
    shards.
    """
    spark = items.sparkSession
    bounded_batches(spark)
    path = f"{checkpoint_dir(spark)}/benchmark-{uuid.uuid4().hex}"
    found = item_words(items, id_col, text_col)
    n_items, avg_len, longest = found.agg(F.count("*"), F.avg(F.size("words")), F.max(F.size("words"))).first()
    if not longest:
        return
    n_shards = -(-n_items // SHARD_ITEMS)
    found.withColumn("shard", F.pmod(F.xxhash64("id", "text"), F.lit(n_shards)).cast("int")).write.partitionBy("shard").parquet(path)
    try:
        kept = spark.read.schema("id long, text string, words array<string>, shard int").parquet(path)
        df_all = kept.select(F.explode(F.array_distinct("words")).alias("w")).groupBy("w").agg(F.count(F.lit(1)).alias("n"))
        for k in range(n_shards):
            mine = kept.where(F.col("shard") == k)
            vocabulary = mine.select(F.explode("words").alias("w")).distinct()
            df = {r["w"]: r["n"] for r in df_all.join(vocabulary, "w").collect()}  # the words of one shard
            rows = sorted(((r["id"], r["text"]) for r in mine.select("id", "text").collect()),
                          key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
            if df:
                yield build(rows, df, n_items, max(avg_len, 1.0), longest)
    finally:
        delete(spark, path)  # the indexes hold all of it


_FOUND = "array<struct<item_id:long,score:double,question:double,answer:double>>"


def find(docs: DataFrame, items: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with ``__found``: the verified items of each row (never null)."""
    bounded_batches(docs.sparkSession)
    out = docs.withColumn("__found", F.array().cast(_FOUND))
    found = pa.list_(pa.struct([("item_id", pa.int64()), ("score", pa.float64()), ("question", pa.float64()),
                                ("answer", pa.float64())]))
    for ix in shards(items):
        sent = docs.sparkSession.sparkContext.broadcast(ix)  # one shard

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            index = sent.value
            for b in batches:
                got = matches(index, b.column(b.schema.get_field_index(text_col)).to_pylist())
                old = b.column(b.schema.get_field_index("__found")).to_pylist()
                new = pa.array([x + [dict(zip(("item_id", "score", "question", "answer"), m)) for m in y]
                                for x, y in zip(old, got)], found)
                at = b.schema.get_field_index("__found")
                yield b.set_column(at, "__found", new) if hasattr(b, "set_column") else pa.RecordBatch.from_arrays(
                    [new if i == at else c for i, c in enumerate(b.columns)], names=b.schema.names)
        out = out.mapInArrow(run, T.StructType(out.schema.fields))
    return out


def contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, item_id, score, question_overlap, answer_overlap): one row per document row and item (id and text) found."""
    hits = find(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), items, "text")
    return hits.select("doc_id", F.explode("__found").alias("f")).select(
        "doc_id", F.col("f.item_id").alias("item_id"), F.col("f.score").alias("score"),
        F.col("f.question").alias("question_overlap"), F.col("f.answer").alias("answer_overlap"))


def keep_clean(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Rows in which no item is found; the columns of ``docs``, whatever their names, unchanged."""
    plain, back = apart(docs, {"__found"})
    return find(plain, items).where(F.size("__found") == 0).select(*back)
