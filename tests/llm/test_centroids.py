"""Centroid clustering against a brute-force version."""

import hashlib
import math
import random

import numpy as np
import pytest

from eventide.llm import centroids

SCHEMA = "vec_id long, embedding array<float>, cluster string, id string, v string, distance string"


def brute(rows, k=8, rounds=10, seed=3, dims=64):
    kept = [(i, [math.floor(1024 * float(np.float32(x))) for x in e]) for i, e in rows
            if e is not None and len(e) == dims and all(x is not None and math.isfinite(x) for x in e)]
    order = sorted(kept, key=lambda r: (hashlib.sha256(f"{seed}:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    c = [list(v) for _, v in order[:k]]

    def assign():
        out = []
        for _, v in kept:
            out.append(min((sum((a - b) ** 2 for a, b in zip(v, m)), n) for n, m in enumerate(c)))
        return out
    for _ in range(rounds):
        got = assign()
        for n in range(len(c)):
            mine = [v for (_, v), (_, m) in zip(kept, got) if m == n]
            if mine:
                c[n] = [sum(col) // len(mine) for col in zip(*mine)]
    got = assign()
    total = sum(d for d, _ in got)
    by = [sum(d for d, m in got if m == n) for n in range(len(c))]
    sha = [hashlib.sha256(",".join(map(str, m)).encode()).hexdigest() for m in c]
    return sorted((-1 if i is None else i, m, d, by[m], total, sha[m]) for (i, _), (d, m) in zip(kept, got))


def run(spark, rows, **kw):
    df = spark.createDataFrame([(i, e, "c", "i", "v", "d") for i, e in rows], SCHEMA)
    return sorted((-1 if r["vec_id"] is None else r["vec_id"], r["cluster"], r["distance"], r["cluster_inertia"], r["inertia"],
                   r["centroid_sha256"]) for r in centroids.cluster(df, **kw).collect())


def vectors(n, dims, seed=1, spread=0.2):
    r = random.Random(seed)
    heads = [[r.uniform(-1, 1) for _ in range(dims)] for _ in range(6)]
    return [(i, [float(np.float32(x + r.gauss(0, spread))) for x in r.choice(heads)]) for i in range(n)]


@pytest.mark.parametrize("dims,spread,block", [(64, 0.2, 16), (64, 1.5, 512), (2, 0.3, 8)])
def test_clusters_equal_brute_force(spark, dims, spread, block):
    rows = vectors(300, dims, spread=spread)
    assert run(spark, rows, dims=dims, block=block) == brute(rows, dims=dims)


def test_bad_vectors_repeats_and_ties(spark):
    rows = vectors(40, 4)
    rows += [(40, None), (41, [1.0, 2.0]), (42, [1.0, None, 0.0, 0.0]), (43, [float("nan")] * 4),
             (44, [float("inf"), 0.0, 0.0, 0.0]), (None, [0.5] * 4), (None, [0.5] * 4)]
    rows += [(7, rows[7][1])] * 60  # a third of all rows
    rows += [(50, [-0.0005, 0.0005, -2.0, 0.0])]
    assert run(spark, rows, dims=4, block=8) == brute(rows, dims=4)


def test_large_components_and_few_vectors(spark):
    rows = [(1, [60000.0, -60000.0]), (2, [-60000.0, 60000.0]), (3, [60000.0, -59999.0])]
    assert run(spark, rows, dims=2) == brute(rows, dims=2)
    held = run(spark, [(1, [3e38, 0.0]), (2, [0.0, 0.0]), (3, [0.0, 0.0])], dims=2, k=1, rounds=0)
    assert max(r[2] for r in held) == centroids.MAX_COMPONENT ** 2
    assert run(spark, [], dims=2) == []


def test_curve_visits_neighbours():
    cells = np.array([(i, j, k) for i in range(8) for j in range(8) for k in range(8)])
    order = sorted(range(len(cells)), key=lambda i, keys=centroids.hilbert_keys(cells, 3): keys[i])
    assert all(np.abs(cells[a] - cells[b]).sum() == 1 for a, b in zip(order, order[1:]))


def test_bounds_settle_blocks_and_lose_no_centroid():
    r = np.random.default_rng(5)
    settled = 0
    for n in range(400):
        c = r.integers(-1000, 1000, (8, 4))
        x = r.integers(-1000, 1000, 4) + r.integers(-60, 60, (30, 4))
        if n % 2:
            x[0] = c[3]
        picks = centroids.candidates(x.min(0), x.max(0), c)
        assert set(centroids.distances(x, c).argmin(1)) <= set(picks)
        settled += len(picks) == 1
    assert settled > 50
