"""Stages keep columns whose names they use themselves; op3 and op4 at sizes beyond a shard and a block."""

import hashlib
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from eventide.llm import decontaminate, langid, secrets, simhash

NAMES = ["score", "lang_pred", "held_out", "spans", "ids", "__text", "__base", "__rest", "__spans", "__new", "__found", "__h", "__n",
         "__no_id", "n", "h", "no_id", "found", "root", "fp", "Score", "score_in"]


def rows(spark, texts, names):
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{n}` double" for n in names)
    return spark.createDataFrame([(i, t, "en" if i % 2 else "de", "s", len(t or ""), *[i + k / 100 for k in range(len(names))])
                                  for i, t in enumerate(texts)], schema)


@pytest.mark.parametrize("stage", ["langid", "simhash", "decontaminate", "secrets"])
def test_stages_keep_columns_of_any_name(spark, stage):
    names = [n for n in NAMES if n != "Score"]
    words = ["the quick brown fox jumps over the lazy dog again and again", "der schnelle braune Fuchs springt heute wieder",
             "password = hunter2hunter2 and more", "what is the answer to it all. forty two of them. indeed so it is",
             "", None] + [f"other text number {i} with some words of its own {i * 7}" for i in range(20)]
    docs = rows(spark, words, names)
    items = spark.createDataFrame([(1, "what is the answer to it all. forty two of them. indeed so it is")], "item_id long, text string")
    out = {"langid": lambda: langid.keep_identified(docs), "simhash": lambda: simhash.keep_first(docs, k=4, max_bits=4),
           "decontaminate": lambda: decontaminate.keep_clean(docs, items), "secrets": lambda: secrets.redact(docs)}[stage]()
    assert out.columns == docs.columns and out.schema.simpleString() == docs.schema.simpleString()
    got = out.collect()
    assert got
    for r in got:
        assert [r[n] for n in names] == [pytest.approx(r["doc_id"] + k / 100) for k in range(len(names))]
    if stage == "decontaminate":
        assert 3 not in {r["doc_id"] for r in got} and len(got) == len(words) - 1
    if stage == "secrets":
        assert {r["doc_id"]: r["text"] for r in got}[2] == "[SECRET] and more"


def test_op3_is_the_same_in_one_and_in_many_shards(spark, monkeypatch):
    hindi = ["भारत की राजधानी क्या है और वह कहाँ स्थित है। दिल्ली उत्तर भारत में स्थित है", "किताब का लेखक कौन है? प्रेमचंद ने यह उपन्यास लिखा था",
             "नदी का नाम क्या है जो हिमालय से निकलती है? गंगा नदी"]
    items = hindi + [f"question number {i} asks what is {i * 3}. the answer is {i * 3} of course" for i in range(30)]
    bench = spark.createDataFrame([(i if i % 5 else None, t) for i, t in enumerate(items)] + [(90, ""), (91, None)],
                                  "item_id long, text string")
    texts = [f"before it {t} and after it" for t in items] + [" ".join(t.split()[:6]) for t in hindi] + ["nothing here", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")

    def run():
        return sorted(map(tuple, decontaminate.contaminated(docs, bench).collect()), key=repr)
    one = run()
    monkeypatch.setattr(decontaminate, "SHARD_ITEMS", 2)
    assert run() == one and {r[0] for r in one} >= set(range(len(items)))


def test_op4_spans_of_texts_with_many(spark):
    r = np.random.default_rng(3)
    parts = []
    for i in range(3000):
        hexed = hashlib.md5(str(i).encode()).hexdigest()
        parts.append(r.choice([f"token={hexed}", hexed, f"AKIA{hexed.upper()[:16]}", f"é secret: \"{hexed[:9]}\"", "plain words\n",
                               f"x{hexed}_{hexed[:10].upper()}q", "api-key"]))
    text = " ".join(parts)
    model = np.zeros(len(secrets.ALPHABET) ** 2)
    model += 1.0  # every token of 9 characters or more counts as random
    df = spark.createDataFrame([(1, text), (2, "z" * 2000), (3, "")], "doc_id long, text string")
    got = {x["doc_id"]: x for x in secrets.scan(df, model=model).select("doc_id", "__base", "__rest", "__spans").collect()}

    def base(t):
        found = []
        for m in re.finditer(secrets.ASSIGN, t):
            if len(m[2]) >= 8:
                found.append((m.start(), 0, m.end()))
        found += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", t) if len(m[0]) >= 16]
        found += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", t) if len(m[0]) >= 32]
        return sorted(found)
    want = base(text)
    assert [tuple(x) for x in got[1]["__base"]] == want
    rest = list(text)
    for a, _, b in want:
        rest[a:b] = " " * (b - a)
    assert got[1]["__rest"] == "".join(rest)
    scored = [(m.start(), 3, m.end()) for m in re.finditer(secrets.TOKEN, "".join(rest)) if len(m[0]) - 1 >= secrets.MIN_LLR]
    assert [tuple(x) for x in got[1]["__spans"]] == sorted(want + scored)
    assert [tuple(x) for x in got[2]["__spans"]] == [(0, 3, 2000)] and got[3]["__spans"] == []
    masked, at = [], 0
    for a, _, b in sorted(want + scored):
        if a >= at:
            masked += [text[at:a], secrets.MASK]
        at = max(at, b)
    df = df.where("doc_id = 1")
    out = df.select("text").withColumn("s", F.lit(None))
    found = secrets.scan(df, model=model).withColumn("m", secrets._filled(
        "__text", "__spans", lambda s, before: F.when(s["start"] >= before, secrets.MASK).otherwise("")))
    assert out.count() == 1 and found.first()["m"] == "".join(masked) + text[at:]


def test_op4_long_token_scores_as_short_ones_do(spark):
    r = np.random.default_rng(4)
    model = r.normal(0, 1, len(secrets.ALPHABET) ** 2)
    tokens = ["".join(r.choice(list(secrets.ALPHABET), n)) for n in (8, 255, 256, 257, 3000)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(tokens)], "doc_id long, text string")
    got = {x["doc_id"]: len(x["s"]) for x in df.withColumn("__rest", F.col("text")).select(
        "doc_id", secrets.random_spans(model).alias("s")).collect()}
    n = len(secrets.ALPHABET)
    for i, t in enumerate(tokens):
        at = [secrets.ALPHABET.index(c) for c in t]
        assert got[i] == int(sum(model[a * n + b] for a, b in zip(at, at[1:])) >= secrets.MIN_LLR)
