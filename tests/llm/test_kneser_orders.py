"""The n-gram model of every order against a version over dictionaries."""

import collections
import math
import os
import sys

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from test_llm import corpus, empty, frame  # noqa: E402

from eventide.llm import kneser  # noqa: E402


def brute(texts, trained, order):
    """(score of each text, sums of p(.|u) over the vocabulary and an unknown word)."""
    tokens = [[w.decode() for w in (t or "").encode().lower().split()] + ["</s>"] for t in texts]
    windows = [[tuple((["<s>"] * (order - 1) + ws)[i:i + order]) for i in range(len(ws))] for ws in tokens]
    counts = [None] * order + [collections.Counter(g for i in trained for g in windows[i])]
    for n in range(order - 1, 0, -1):
        counts[n] = collections.Counter(g[1:] for g in counts[n + 1])
    vocabulary = {w for i in trained for w in tokens[i]}
    of = [np.array([sum(x == k for x in c.values()) for k in (1, 2, 3, 4)], float) for c in counts[1:]]
    d = [None] + [kneser.discounts(x) for x in of]
    total = [None, sum(counts[1].values())] + [collections.Counter() for _ in range(2, order + 1)]
    free = [None] + [collections.Counter() for _ in range(1, order + 1)]
    for n in range(1, order + 1):
        for g, c in counts[n].items():
            if n > 1:
                total[n][g[:-1]] += c
            free[n][g[:-1]] += d[n][min(c, 3) - 1]

    def p(gram):
        n = len(gram)
        c = counts[n][gram]
        kept = max(c - d[n][min(c, 3) - 1], 0) if c else 0
        if n == 1:
            return kept / total[1] + free[1][()] / total[1] / (len(vocabulary) + 1)
        u = gram[:-1]
        return kept / total[n][u] + free[n][u] / total[n][u] * p(gram[1:]) if u in total[n] else p(gram[1:])
    contexts = [g[:-1] for g in list(counts[order])[:5]] + [("never seen",) * (order - 1)]
    sums = [sum(p((*u, w)) for w in [*vocabulary, "never seen"]) for u in contexts]
    return [sum(math.log10(p(g)) for g in gs) for gs in windows], sums


@pytest.mark.parametrize("order", [2, 3, 5])
@pytest.mark.parametrize("shards,batch,frequent", [(3, 500, ["the", "red"]), (1, 10_000_000, []), (4, 300, None)])
def test_orders(spark, monkeypatch, order, shards, batch, frequent):
    if frequent is not None:  # what counts as frequent places work only
        hashes = np.sort(np.array([kneser.BEGIN, *(kneser.xxhash.xxh64_intdigest(w) for w in frequent)], np.uint64))
        monkeypatch.setattr(kneser, "frequent_words", lambda *_: hashes)
    texts = corpus(40)
    got = kneser.score(frame(spark, texts).repartition(3), F.col("doc_id") % 5 != 1, F.col("doc_id") % 5 == 1,
                       shards=shards, batch_tokens=batch, order=order).collect()
    want, sums = brute(texts, [i for i in range(40) if i % 5 != 1], order)
    assert np.allclose(sums, 1)
    assert sorted(r["doc_id"] for r in got) == list(range(40))
    for r in got:
        assert r["score"] == pytest.approx(want[r["doc_id"]])
        assert r["perplexity"] == pytest.approx(10 ** (-want[r["doc_id"]] / r["n_tokens"]))


def test_edges(spark):
    assert kneser.score(empty(spark), F.lit(True), F.lit(False), order=3).count() == 0
    none = kneser.score(frame(spark, ["a b", None]), F.lit(False), F.lit(True), order=4).collect()
    assert [(r["train_tokens"], r["score"], r["perplexity"]) for r in none] == [(0, 0.0, 1.0)] * 2
    with pytest.raises(ValueError):
        kneser.score(empty(spark), F.lit(True), F.lit(False), order=1)
    held = kneser.score(frame(spark, ["a b", "a b"]).withColumn("shard", F.lit("x")).withColumn("score", F.lit("y")),
                        F.col("doc_id") == 0, F.col("doc_id") == 1, order=3).collect()
    assert held[0]["score"] == pytest.approx(held[1]["score"])


def test_messages_do_not_grow_with_the_shards():
    """Words of the sample go by number: a message's cost follows its n-grams, not the words that every shard repeats."""
    rng = np.random.default_rng(3)
    hashes = np.unique(rng.integers(1, 1 << 63, 5000, np.uint64))[rng.permutation(5000)]
    docs = [(i, i % 5 != 1, i % 5 == 1, hashes[np.minimum(rng.zipf(1.3, 200) - 1, 4999)]) for i in range(500)]
    common = np.insert(hashes[:4000], 0, kneser.BEGIN)
    size, grams = {}, {}
    for shards in (4, 64):
        got = list(kneser.deal(docs, shards, np.array([kneser.BEGIN]), 0, 3, common))
        size[shards] = sum(len(body) for _, _, kind, body in got if kind == kneser.BLOB)
        read = [kneser.Message(body, common) for _, _, kind, body in got if kind == kneser.BLOB]
        grams[shards] = np.sort(np.concatenate([np.repeat(m.grams[-1], m.per_gram) for m in read]))
    assert size[64] < 1.25 * size[4]
    padded = [np.concatenate(([kneser.BEGIN] * 2, d[3], [kneser.END])).astype(np.uint64) for d in docs]
    want = np.sort(np.concatenate([kneser.pair_hash(x[:-2], kneser.pair_hash(x[1:-1], x[2:])) for x in padded]))
    for x in grams.values():
        assert len(x) <= len(want) and np.array_equal(np.unique(x), np.unique(want))
    assert np.array_equal(kneser.from_gaps(kneser.gaps(hashes)), hashes)


def test_sampled_words_are_counted_whole(spark):
    texts = ["a b b", None, "", "b c " + "x" * 70] * 3
    hashes, count, total = kneser.sampled_words(frame(spark, texts), "text", 1000, share=1.0)
    found = dict(zip(hashes.tolist(), count.tolist()))
    assert found[kneser.xxhash.xxh64_intdigest(b"b")] == 9 and list(count) == sorted(count, reverse=True)
    assert total >= 21 and len(kneser.sampled_words(empty(spark), "text", 4)[0]) == 0
