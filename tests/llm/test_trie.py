"""Conversation prefix trie against a brute-force version."""

import collections
import hashlib
import random
import zlib

import numpy as np
import pytest

from eventide.llm import trie

SCHEMA = "conv_id long, turn long, role string, text string, part string, digest string, size string, shard long"


def turn_digest(role, text):
    return hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()[:16]


def brute(rows, fork=True):
    convs = collections.defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            convs[c].append((turn is not None, turn or 0, turn_digest(role or "", text or ""), role or "", text or ""))
    convs = {c: [t[3:] for t in sorted(ts)] for c, ts in convs.items()}
    rebuilt = {}
    for c, ts in convs.items():
        h = zlib.crc32(str(c).encode()) % 9
        rebuilt[c] = convs.get(c - c % 5, [])[:h] + ts[h:] if fork else ts
    members, ends = collections.defaultdict(list), collections.defaultdict(list)
    for c, ts in sorted(rebuilt.items()):
        for d in range(len(ts) + 1):
            members[tuple(ts[:d])].append(c)
        ends[tuple(ts)].append(c)
    kids = collections.Counter(k[:-1] for k in members if k)
    leaves, saved = collections.Counter(), collections.Counter()
    for k, m in members.items():
        for d in range(len(k) + 1):
            leaves[k[:d]] += not kids[k]
            saved[k[:d]] += (len(m) - 1) * len(k[-1][1].encode()) if k else 0
    return sorted((m[0], len(k), members[k[:-1]][0] if k else None, len(m), kids[k], leaves[k], saved[k],
                   hashlib.sha256(",".join(map(str, ends[k])).encode()).hexdigest()) for k, m in members.items())


def run(spark, rows, fork=True, **kw):
    df = spark.createDataFrame([(*r, "p", "d", "s", 1) for r in rows], SCHEMA)
    got = trie.build(df, trie.FORK if fork else None, **kw).collect()
    return sorted((r["conv_id"], r["depth"], r["parent_conv_id"], r["n_convs"], r["n_children"], r["n_leaves"], r["saved_tokens"],
                   r["ends_sha256"]) for r in got)


def conversations(n, seed=1):
    r = random.Random(seed)
    texts = ["a", "b", "é" * 3, "", None, "long " * 50]
    rows = []
    for c in range(-7, n):
        if r.random() < 0.2:
            continue
        for turn in range(r.choice([1, 2, 5, 9, 12])):
            rows.append((c, turn, r.choice(["user", None]), r.choice(texts[:2] if r.random() < 0.7 else texts)))
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize("fork,shard_rows", [(True, 1 << 17), (True, 20), (False, 1), (True, 1)])
def test_trie_equals_brute_force(spark, fork, shard_rows):
    rows = conversations(60)
    assert run(spark, rows, fork, shard_rows=shard_rows) == brute(rows, fork)


def test_nulls_ties_repeats_and_a_hot_conversation(spark):
    rows = conversations(20, seed=2)
    rows += [(None, 0, "user", "x"), (3, None, "user", "first"), (3, 2, "user", "tie"), (3, 2, "user", "tie"), (3, 2, "a", "tied")]
    rows += [(c, t, "user", f"same {t}") for c in range(100, 160) for t in range(3)]  # copies of one conversation
    rows += [(8, t, "user", f"t{t}") for t in range(300)]
    assert run(spark, rows, shard_rows=50) == brute(rows)


def test_turnless_and_empty(spark):
    short = [c for c in range(1, 200) if c % 5 and zlib.crc32(str(c).encode()) % 9 > 1][:3]
    rows = [(c, 0, "user", "only") for c in short]  # all own turns are replaced, by none
    got = run(spark, rows)
    assert got == brute(rows) and len(got) == 1 and got[0][1] == 0
    assert run(spark, []) == []


def test_slots_are_minimal_and_verified():
    keys = np.unique(np.random.default_rng(1).integers(0, 1 << 63, (5000, 2)).astype(np.uint64), axis=0)
    s = trie.Slots.unpack(trie.Slots.build(keys[:4000]).pack(), trie.Slots.build(keys[:4000]).keys)
    assert sorted(s.find(keys[:4000])) == list(range(4000))
    assert (s.keys[s.find(keys[:4000])] == keys[:4000]).all()
    assert (s.find(keys[4000:]) == -1).all()
