"""Best-fit packing against the tokenizers library and the rules of a packing."""

import collections
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from eventide.llm import packing
from eventide.llm.queries import WORD_BPE

SCHEMA = "doc_id long, text string, key long, bin string, ids string, length string"


def frame(spark, texts, ids=None):
    ids = range(len(texts)) if ids is None else ids
    return spark.createDataFrame([(i, t, 9, "b", "x", "l") for i, t in zip(ids, texts)], SCHEMA)


def library():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(WORD_BPE)


def expected(texts, capacity):
    """(text number, piece, start, length, crc32) of every piece, by the library on whole texts."""
    t, out = library(), []
    for i, x in enumerate(texts):
        ids = [*t.encode(x or "", add_special_tokens=False).ids, 0]
        for n, at in enumerate(range(0, len(ids), capacity)):
            part = np.array(ids[at:at + capacity], "<u4").tobytes()
            out.append((i, n, at, len(part) // 4, zlib.crc32(part)))
    return out


def check(rows, capacity):
    """Sequences are gapless from 0 and within the capacity."""
    by = collections.defaultdict(list)
    for r in rows:
        by[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


def texts(n=200, seed=3):
    r = random.Random(seed)
    words = ["the", "Fox's", "jumps,", "over", "été", "Straße", "日本", "12", "don't", "x" * 90, "Жук", "́a", "<|endoftext|>"]
    out = [" ".join(r.choices(words, k=int(r.paretovariate(0.8) * 4) % 300)) for _ in range(n)]
    out[3], out[4], out[5], out[6] = None, "", out[7], " \n\t "
    return out


@pytest.mark.parametrize("capacity,open_bins", [(64, 4096), (64, 3), (2048, 4096), (1, 5)])
def test_packing_equals_library_and_fills(spark, capacity, open_bins):
    data = texts()
    rows = packing.pack(frame(spark, data), WORD_BPE, 0, capacity, open_bins).collect()
    want = expected(data, capacity)
    assert sorted((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == want
    n = check(rows, capacity)
    least = -(-sum(w[3] for w in want) // capacity)
    assert least <= n <= (least * 1.5 + 4 if open_bins == 3 else least * 1.02 + 2)


def test_packing_nulls_repeats_and_empty(spark):
    data = ["a b", None, "a b", "a b", ""]
    rows = packing.pack(frame(spark, data, [5, None, 5, 5, None]), WORD_BPE, 0, 8).collect()
    assert sorted((r["doc_id"] or -1, r["length"]) for r in rows) == [(-1, 1), (-1, 1), (5, 3), (5, 3), (5, 3)]
    assert check(rows, 8) == 2
    assert packing.pack(frame(spark, []), WORD_BPE, 0).collect() == []


def test_packing_long_text_is_cut_whole(spark):
    data = ["word " * 60000, "tail"]
    rows = packing.pack(frame(spark, data), WORD_BPE, 0).collect()
    assert sum(r["length"] for r in rows if r["doc_id"] == 0) == 60001
    assert sorted(r["piece"] for r in rows if r["doc_id"] == 0) == list(range(30))
    assert check(rows, 2048) == 30


def test_sequences_hold_the_ids(spark):
    data = texts(60)
    packed = packing.pack(frame(spark, data), WORD_BPE, 0, 64)
    seqs = {r["sequence_id"]: r for r in packing.sequences(packed).collect()}
    for r in packed.collect():
        got = bytes(seqs[r["sequence_id"]]["ids"])[4 * r["offset"]:4 * (r["offset"] + r["length"])]
        assert zlib.crc32(got) == r["ids_crc32"]
    assert all(4 * r["n_tokens"] == len(r["ids"]) for r in seqs.values())


def test_words_are_encoded_as_in_the_text():
    codes = packing.WordCodes(open(WORD_BPE, encoding="utf-8").read())
    assert codes.by_word
    t, r = library(), random.Random(1)
    pool = [*"abXZ 's'T'RE'Ve.,!_<|>09 \n\t\r\x0b\x0c\x00\x1c\x85  éÉßıİΣσςЖжñ́ͅΐŉﬁJ̌İ你好🙂²½", "<|endoftext|>", "I'LL"]
    for _ in range(3000):
        s = "".join(r.choices(pool, k=r.randint(0, 14)))
        ids, bounds = codes.encode(pa.array([s, None, s[::-1]]))
        assert [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])] == [
            t.encode(x, add_special_tokens=False).ids for x in (s, "", s[::-1])]


def test_open_bins_best_fit():
    b = packing.OpenBins(10, 2)
    assert [b.place(n) for n in (6, 7, 3, 4)] == [(0, 0), (1, 0), (1, 7), (0, 6)]  # the smallest gap that holds it
    assert not b.left() and b.free == 0
    assert [b.place(n) for n in (6, 8, 9)] == [(2, 0), (3, 0), (4, 0)]
    assert sorted(b.left()) == [(2, 6), (4, 9)]  # the fuller of 6 and 8 was closed
