"""Randomised payload trees: discovery against a small pure-Python model."""

import json
import random

import pytest

from eventide.operators.discovery import discover

KEYS = ["a", "b", "c"]


def tname(v):
    if isinstance(v, bool):
        return "boolean"
    if isinstance(v, str):
        return "string"
    if isinstance(v, int):
        return "integer" if -2 ** 31 <= v < 2 ** 31 else "long"
    if isinstance(v, float):
        return "double"
    if isinstance(v, list):
        return "array"
    if isinstance(v, dict):
        return "object"
    return "null"


def walk(node, prefix, out):
    for k, v in node.items():
        p = k if not prefix else prefix + "." + k
        out[p] = tname(v)
        if isinstance(v, dict):
            walk(v, p, out)
        elif isinstance(v, list) and v and isinstance(v[0], dict):
            walk(v[0], p + "[*]", out)


def model(docs):
    merged = {}
    for d in docs:
        one = {}
        if isinstance(d, dict):
            walk(d, "", one)
        for p, t in one.items():
            if p in merged:
                merged[p] = (merged[p][0], merged[p][1] + 1)
            else:
                merged[p] = (t, 1)
    return merged


def rand_value(r, depth):
    x = r.random()
    if depth < 3 and x < 0.3:
        return {k: rand_value(r, depth + 1) for k in r.sample(KEYS, r.randint(0, 3))}
    if depth < 3 and x < 0.4:
        return [rand_value(r, depth + 1) for _ in range(r.randint(0, 2))]
    if x < 0.55:
        return r.choice([1, -7, 5000000000, 2 ** 31])
    if x < 0.65:
        return r.choice([True, False])
    if x < 0.72:
        return None
    if x < 0.8:
        return 1.5
    return "s"


@pytest.mark.parametrize("seed", range(12))
def test_random_discovery(payloads, seed):
    r = random.Random(100 + seed)
    docs = [({k: rand_value(r, 0) for k in r.sample(KEYS, r.randint(0, 3))} if r.random() > 0.1 else
             r.choice([[1], "x", None])) for _ in range(8)]
    got = {row["path"]: (row["type"], row["occurrences"]) for row in discover(payloads(*docs)).collect()}
    assert got == model(docs), json.dumps(docs)
