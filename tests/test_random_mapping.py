"""Randomised mapping lists and payload trees against a small pure-Python model
of the reference's tree-at-a-time mapping semantics."""

import json
import random

import pytest
from pyspark.sql import functions as F

from eventide.model import m
from eventide.operators.mapping import compile_mappings

KEYS = ["a", "b", "c"]
CONVS = [None, "NONE", "TO_STRING", "TO_UPPER", "TO_LOWER", "MASK", "FLATTEN", "TO_BOOLEAN"]
MISSING = object()


def split(path):
    if path is None or path == "":
        return None
    parts = path.split(".")
    while parts and parts[-1] == "":
        parts.pop()
    return parts


def resolve(node, path):
    parts = split(path)
    if parts is None:
        return MISSING
    cur = node
    for p in parts:
        if not isinstance(cur, dict):
            return MISSING
        cur = cur.get(p, MISSING)
    return cur


def text(v):
    if isinstance(v, bool):
        return "true" if v else "false"
    if isinstance(v, (dict, list)):
        return ""
    return str(v)


def convert(v, c):
    if c in (None, "NONE", "FLATTEN"):
        return v
    t = text(v)
    return {"TO_STRING": lambda: t, "TO_UPPER": lambda: t.upper(), "TO_LOWER": lambda: t.lower(),
            "MASK": lambda: "**" if len(t) <= 2 else t[0] + "*" * (len(t) - 2) + t[-1],
            "TO_BOOLEAN": lambda: v if isinstance(v, bool) else t.strip().lower() == "true"}[c]()


def set_field(out, path, value):
    parts = split(path)
    if not parts:
        return
    cur = out
    for p in parts[:-1]:
        if not isinstance(cur.get(p), dict):
            cur[p] = {}
        cur = cur[p]
    cur[parts[-1]] = value


def model(payload, mappings):
    out = {}
    for mp in mappings:
        if mp.excluded:
            continue
        v = resolve(payload, mp.source_field)
        if v is MISSING or v is None:
            if mp.default_value is None:
                continue
            v = mp.default_value
        if mp.conversion == "FLATTEN" and isinstance(v, dict):
            for k, child in v.items():
                if mp.destination_field:
                    set_field(out, mp.destination_field + "." + k, json.loads(json.dumps(child)))
                else:
                    out[k] = json.loads(json.dumps(child))
            continue
        set_field(out, mp.destination_field, json.loads(json.dumps(convert(v, mp.conversion))))
    return out


def rand_value(r, depth):
    x = r.random()
    if depth < 2 and x < 0.3:
        return {k: rand_value(r, depth + 1) for k in r.sample(KEYS, r.randint(0, 3))}
    if x < 0.4:
        return [rand_value(r, depth + 1) for _ in range(r.randint(0, 2))]
    if x < 0.55:
        return r.randint(-50, 50)
    if x < 0.65:
        return r.choice([True, False])
    if x < 0.7:
        return None
    return "".join(r.choice("xyZ ") for _ in range(r.randint(0, 5)))


def rand_path(r, allow_empty):
    if allow_empty and r.random() < 0.1:
        return r.choice([None, ""])
    return ".".join(r.choice(KEYS) for _ in range(r.randint(1, 3)))


def rand_mappings(r):
    out = []
    for _ in range(r.randint(1, 5)):
        out.append(m(rand_path(r, False), rand_path(r, True), r.choice(CONVS),
                     r.choice([None, None, "d", "True"]), r.random() < 0.1))
    return out


@pytest.mark.parametrize("seed", range(30))
def test_random_mappings(spark, seed):
    r = random.Random(seed)
    payloads = [{k: rand_value(r, 0) for k in r.sample(KEYS, r.randint(0, 3))} for _ in range(6)]
    maps = rand_mappings(r)
    df = spark.createDataFrame([(i, json.dumps(p)) for i, p in enumerate(payloads)], "seq int, p string")
    out = compile_mappings(df.select("seq", F.parse_json("p").alias("payload")), maps)
    got = {row["seq"]: json.loads(row["o"]) for row in out.select("seq", F.to_json("mapped").alias("o")).collect()}
    for i, p in enumerate(payloads):
        assert got[i] == model(p, maps), (p, maps)
