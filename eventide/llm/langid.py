"""Language identification with script ranges and Viterbi over word scores.

* Features: hashed character trigrams of lower-cased words (runs of letters of
  one script), with word boundaries; ``BUCKETS`` counters per language, so the
  model's size is ``BUCKETS`` numbers per distinct label whatever the corpus.
* Training counts every training text, in Python tasks that keep one counter
  array per label, summed by Spark.
* A word's candidates are the languages with at least ``MIN_SHARE`` of their
  training letters in the word's script; other languages pay ``OFF_SCRIPT``
  per letter. A script that no language was seen in leaves the word neutral.
* Viterbi over the words' log-likelihoods with a cost of ``SWITCH`` per change
  of language labels spans. Where no stretch of words gains more than one
  switch over the best single language, that language is the optimal path and
  the walk is skipped (the bound is exact).

Null text and text without letters: ``und`` with score 0 and no spans. Without
any training text every document is ``und``. Null labels are not learned from.
Ties go to the first language in name order. Every input row gives one row.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventide.llm.common import apart, bounded_batches

BUCKETS = 1 << 15
SMOOTHING = 0.5
MIN_SHARE = 0.001
OFF_SCRIPT = 4.0
SWITCH = 10.0
#: Numbers of one score table that a task holds at a time (characters times languages).
CELLS = 4_000_000
UNKNOWN = "und"
#: A document is kept by the filter when this share of its letters is in its language.
MIN_SCORE = 0.3

# Code point ranges of scripts (other letters are script 255).
SCRIPTS = {
    1: [(0x41, 0x5A), (0x61, 0x7A), (0xAA, 0xAA), (0xBA, 0xBA), (0xC0, 0x2AF), (0x1E00, 0x1EFF), (0x2C60, 0x2C7F),
        (0xA720, 0xA7FF), (0xFB00, 0xFB06), (0xFF21, 0xFF3A), (0xFF41, 0xFF5A)],
    2: [(0x370, 0x3FF), (0x1F00, 0x1FFF)],
    3: [(0x400, 0x52F), (0x1C80, 0x1C8F), (0x2DE0, 0x2DFF), (0xA640, 0xA69F)],
    4: [(0x530, 0x58F)], 5: [(0x590, 0x5FF)], 6: [(0x600, 0x6FF), (0x750, 0x77F), (0x8A0, 0x8FF), (0xFB50, 0xFDFF),
                                                  (0xFE70, 0xFEFF)],
    7: [(0x900, 0x97F)], 8: [(0x980, 0x9FF)], 9: [(0xA00, 0xA7F)], 10: [(0xA80, 0xAFF)], 11: [(0xB80, 0xBFF)],
    12: [(0xC00, 0xC7F)], 13: [(0xC80, 0xCFF)], 14: [(0xD00, 0xD7F)], 15: [(0xE00, 0xE7F)], 16: [(0x10A0, 0x10FF)],
    17: [(0x1100, 0x11FF), (0xAC00, 0xD7AF)], 18: [(0x1200, 0x137F)], 19: [(0x3040, 0x309F)], 20: [(0x30A0, 0x30FF)],
    21: [(0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x2FA1F)],
}
OTHER = 255


@cache
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Script (0: no letter) and lower case of every code point."""
    script = np.zeros(0x110000, np.uint8)
    lower = np.arange(0x110000, dtype=np.uint32)
    for c in range(0x30000):
        ch = chr(c)
        if ch.isalpha():
            script[c] = OTHER
            low = ch.lower()
            if len(low) == 1:
                lower[c] = ord(low)
    for number, ranges in SCRIPTS.items():
        for a, b in ranges:
            part = script[a:b + 1]
            part[part > 0] = number
    return script, lower


@dataclass
class Model:
    langs: list[str]
    logp: np.ndarray  # (BUCKETS, languages) float32
    allowed: np.ndarray  # (256, languages) bool


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def _features(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Letter positions, their trigram buckets, the first letter (index) of each word, scripts of the letters."""
    script, lower = _tables()
    kind = script[codes]
    at = np.flatnonzero(kind)
    if not len(at):
        return at, at, at, kind[at]
    low = lower[codes[at]]
    kinds = kind[at]
    begin = np.ones(len(at), bool)
    begin[1:] = (at[1:] != at[:-1] + 1) | (kinds[1:] != kinds[:-1])
    before = np.zeros(len(at), np.uint32)
    before[1:] = np.where(begin[1:], 0, low[:-1])
    after = np.zeros(len(at), np.uint32)
    after[:-1] = np.where(begin[1:], 0, low[1:])
    with np.errstate(over="ignore"):
        h = before * np.uint32(0x9E3779B1) ^ low * np.uint32(0x85EBCA77) ^ after * np.uint32(0xC2B2AE3D)
        h = (h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
    return at, (h >> np.uint32(17)).astype(np.int64), np.flatnonzero(begin), kinds


def _pieces(text: str, most: int) -> Iterator[tuple[int, str]]:
    """Cuts of a text of about ``most`` characters, between words where there is a gap."""
    i = 0
    while i < len(text):
        j = i + most
        while j < len(text) and j < i + 2 * most and text[j].isalpha():
            j += 1
        yield i, text[i:j]
        i = j


def train(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> Model:
    """Trigram counts of all given rows with a label and a text."""
    bounded_batches(docs.sparkSession)
    schema = pa.schema([("lang", pa.string()), ("bucket", pa.int32()), ("n", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = defaultdict(lambda: np.zeros(BUCKETS + 256, np.int64))
        for b in batches:
            for text, lang in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                for _, piece in _pieces(text, CELLS):
                    _, buckets, _, kinds = _features(_codes(piece))
                    if len(buckets):
                        counts[lang] += np.bincount(buckets, minlength=BUCKETS + 256)
                        counts[lang][BUCKETS:] += np.bincount(kinds, minlength=256)
        for lang, c in counts.items():
            at = np.flatnonzero(c)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int32()),
                                              pa.array(c[at])], schema=schema)

    labelled = docs.select(F.col(text_col), F.col(lang_col)).where(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull())
    counted = labelled.mapInArrow(count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(
        F.sum("n").alias("n"))
    table = counted.toArrow()  # BUCKETS + 256 rows per label at most
    names = table.column("lang").to_pylist()
    langs = sorted(set(names))
    number = {x: i for i, x in enumerate(langs)}
    c = np.zeros((BUCKETS + 256, len(langs)))
    c[table.column("bucket").to_numpy(), [number[x] for x in names]] = table.column("n").to_numpy()
    grams, letters = c[:BUCKETS] + SMOOTHING, c[BUCKETS:]
    return Model(langs, np.log(grams / grams.sum(axis=0, keepdims=True)).astype(np.float32),
                 letters >= np.maximum(1, MIN_SHARE * letters.sum(axis=0, keepdims=True)))


def word_scores(model: Model, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(scores of words by language, first character, character after the last) of a text's words."""
    parts: list[tuple] = []
    for off, piece in _pieces(text, max(1000, CELLS // len(model.langs))):
        at, buckets, begin, kinds = _features(_codes(piece))
        if not len(at):
            continue
        s = np.add.reduceat(model.logp[buckets], begin, axis=0, dtype=np.float64)
        size = np.diff(np.append(begin, len(at)))
        ok = model.allowed[kinds[begin]]
        s[~ok.any(axis=1)] = 0
        some = ok.any(axis=1) & ~ok.all(axis=1)
        if some.any():
            least = np.where(ok[some], s[some], np.inf).min(axis=1, keepdims=True)
            s[some] = np.where(ok[some], s[some], least - OFF_SCRIPT * size[some][:, None])
        first = at[begin] + off
        parts.append((s, first, first + size))
    if not parts:
        e = np.zeros(0, np.int64)
        return np.zeros((0, len(model.langs))), e, e
    return tuple(np.concatenate(x) for x in zip(*parts))  # type: ignore[return-value]


def viterbi(scores: list[np.ndarray], switch: float = SWITCH) -> list[np.ndarray]:
    """Best label of each word; documents advance together, longest first."""
    order = sorted(range(len(scores)), key=lambda i: -len(scores[i]))
    size = np.array([len(scores[i]) for i in order])
    s = np.concatenate([scores[i] for i in order])
    off = np.concatenate(([0], np.cumsum(size)[:-1]))
    n = s.shape[1]
    own = np.arange(n, dtype=np.int32)[None, :]
    back = np.empty((len(s), n), np.int32)
    v = s[off].copy()
    for t in range(1, int(size[0])):
        k = int(np.searchsorted(-size, -t, side="left"))  # documents with more than t words
        moved = v[:k].max(axis=1, keepdims=True) - switch
        stay = v[:k] >= moved
        back[off[:k] + t] = np.where(stay, own, v[:k].argmax(axis=1)[:, None])
        v[:k] = np.where(stay, v[:k], moved) + s[off[:k] + t]
    labels = np.empty(len(s), np.int32)
    now = v.argmax(axis=1).astype(np.int32)
    for t in range(int(size[0]) - 1, -1, -1):
        k = int(np.searchsorted(-size, -t, side="left"))
        labels[off[:k] + t] = now[:k]
        if t:
            now[:k] = back[off[:k] + t, now[:k]]
    out: list[np.ndarray] = [np.empty(0, np.int32)] * len(scores)
    for i, a, m in zip(order, off.tolist(), size.tolist()):
        out[i] = labels[a:a + m]
    return out


def _single(s: np.ndarray, switch: float) -> int:
    """The language of an optimal path without a switch, -1 if a switch may pay."""
    best = int(s.sum(axis=0).argmax())
    gain = np.cumsum((s - s[:, best:best + 1]).max(axis=1))
    low = np.minimum.accumulate(np.concatenate(([0.0], gain[:-1])))
    return best if (gain - low).max() <= switch else -1


def label(model: Model, texts: list[str | None]) -> list[tuple[str, float, list[tuple[int, int, str]]]]:
    """(language, share of the letters in its spans, spans) of each text."""
    out: list[tuple] = [(UNKNOWN, 0.0, [])] * len(texts)
    open_: list[tuple[int, tuple]] = []
    held = 0

    def close() -> None:
        nonlocal held
        for (i, w), labels in zip(open_, viterbi([w[0] for _, w in open_])):
            finish(i, w, labels)
        open_.clear()
        held = 0

    def finish(i: int, w: tuple, labels: np.ndarray) -> None:
        _, first, last = w
        letters = np.bincount(labels, weights=last - first, minlength=len(model.langs))
        top = int(letters.argmax())
        cut = np.flatnonzero(np.concatenate(([True], labels[1:] != labels[:-1])))
        ends = np.append(cut[1:], len(labels)) - 1
        spans = [(int(first[a]), int(last[b]), model.langs[labels[a]]) for a, b in zip(cut, ends)]
        out[i] = (model.langs[top], float(letters[top] / letters.sum()), spans)

    for i, text in enumerate(texts):
        if not text or not model.langs:
            continue
        w = word_scores(model, text)
        if not len(w[0]):
            continue
        one = _single(w[0], SWITCH)
        if one >= 0:
            out[i] = (model.langs[one], 1.0, [(int(w[1][0]), int(w[2][-1]), model.langs[one])])
            continue
        open_.append((i, w))
        held += len(w[0]) * len(model.langs)
        if held > CELLS:
            close()
    if open_:
        close()
    return out


def predict(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` and ``spans`` (start, end, lang); columns of these names are replaced."""
    bounded_batches(docs.sparkSession)
    keep = [c for c in docs.columns if c not in ("lang_pred", "score", "spans")]
    docs = docs.select(*keep)
    schema = T.StructType([*docs.schema.fields, *T._parse_datatype_string(
        "lang_pred string, score double, spans array<struct<start:int,end:int,lang:string>>").fields])
    spans = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("lang", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = label(model, b.column(b.schema.get_field_index(text_col)).to_pylist())
            new = [pa.array([x[0] for x in got], pa.string()), pa.array([x[1] for x in got], pa.float64()),
                   pa.array([[{"start": s, "end": e, "lang": g} for s, e, g in x[2]] for x in got], spans)]
            yield pa.RecordBatch.from_arrays([*b.columns, *new], names=[*b.schema.names, "lang_pred", "score", "spans"])

    return docs.mapInArrow(run, schema)


def remainder(id_col: str, n: int) -> Column:
    """crc32 of the id as text, modulo n (null for a null id)."""
    return F.crc32(F.col(id_col).cast("string")) % n


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``docs`` with predictions and ``held_out``; learns from rows whose remainder by 4 is not 2.

    Rows with a null id are neither learned from nor held out.
    """
    model = train(docs.where(remainder(id_col, 4) != 2), text_col, lang_col)
    return predict(docs, model, text_col).withColumn(
        "held_out", F.coalesce(remainder(id_col, 4) == 2, F.lit(False)))


def keep_identified(docs: DataFrame, min_score: float = MIN_SCORE) -> DataFrame:
    """Rows with a language covering ``min_score`` of their letters; the columns of ``docs``, whatever their names, unchanged."""
    plain, back = apart(docs, {"lang_pred", "score", "spans", "held_out"})
    found = identify(plain)
    return found.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= min_score)).select(*back)
