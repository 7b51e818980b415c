"""Texts cut in whole arrays of bytes encode as the library encodes them."""

import random
import time

import numpy as np
import pyarrow as pa
import pytest

from eventide.llm import packing, pretokens, tokenfile
from eventide.llm.queries import BYTE_BPE, WORD_BPE

POOL = [*"abXYZ 's'T'RE'Ve'll'm.,!?-_<|>0912  \n\n\t\r\x0b\x0c\x00\x1c\x85\xa0　éÉßıİΣ×÷À½ЖñJ̌́你好🙂",
        "<|endoftext|>", " don't", "I'LL", "word", " w", "'ve", " 's"]


def texts(n, seed):
    r = random.Random(seed)
    return ["".join(r.choices(POOL, k=r.randint(0, 14))) if n % 9 else None for n in range(n)]


@pytest.mark.parametrize("special_text", [False, True])
def test_byte_level(special_text):
    words = tokenfile._words(open(BYTE_BPE, encoding="utf-8").read(), special_text)
    for seed in range(30):
        data = texts(100, seed)
        got = tokenfile.encode_batch(words, pa.array(data, pa.string()), 2)
        assert [x.tolist() for x in got] == [
            [*words.tokenizer.encode(t or "", add_special_tokens=False).ids, 2] for t in data]


@pytest.mark.parametrize("size", [40, 1 << 20])
def test_long_texts_are_cut_between_words(monkeypatch, size):
    monkeypatch.setattr(pretokens.parts, "__defaults__", (size,))
    r = random.Random(4)
    data = ["", *[" ".join("".join(r.choices("abé'sX1,\n", k=r.randint(0, 9))) for _ in range(200)) for _ in range(5)], "x" * 500]
    words = tokenfile._Words(tokenfile._tokenizer(open(BYTE_BPE, encoding="utf-8").read(), False))
    assert [x.tolist() for x in tokenfile.encode_batch(words, pa.array(data), 2)] == [
        [*words.tokenizer.encode(t, add_special_tokens=False).ids, 2] for t in data]
    codes = packing.WordCodes(open(WORD_BPE, encoding="utf-8").read())
    ids, at = codes.encode(pa.array(data))
    assert [ids[a:b].tolist() for a, b in zip(at, at[1:])] == [
        codes.tokenizer.encode(t, add_special_tokens=False).ids for t in data]
    assert codes.encode(pa.array([], pa.string()))[1].tolist() == [0]


def test_bytes_are_named_as_the_library_names_them():
    names = [pretokens.byte_names(" é" + chr(c) + " x") for c in range(128)]
    plain = {b: chr(pretokens.BYTE_NAMES.get(b, b)) for b in range(256)}
    assert names == ["".join(plain[b] for b in (" é" + chr(c) + " x").encode()) for c in range(128)]
    assert pretokens._NAMES == "".join(plain.values()) and len(set(pretokens._NAMES)) == 256


def test_naming_bytes_takes_no_look_up_by_character():
    units = [f" wörd{n}," for n in range(20_000)]

    def seconds(name):
        spent = []
        for _ in range(5):
            began = time.process_time()
            for u in units:
                name(u)
            spent.append(time.process_time() - began)
        return min(spent)
    assert seconds(pretokens.byte_names) < 0.8 * seconds(lambda u: u.encode().decode("latin-1").translate(pretokens.BYTE_NAMES))


@pytest.mark.parametrize("top", [0, 1, 2, 255, 256, 50_000, (1 << 32) - 1])
def test_level_widths_cost_the_least(top):
    ids = np.random.default_rng(top).integers(0, top + 1, 300).astype(np.uint32)
    ids[0] = top

    def cost(widths):
        total, done, n = 0, 0, len(widths)
        for k, w in enumerate(widths):
            total += int((ids >= 1 << done).sum() if done else len(ids)) * (w + (k + 1 < n) * (1 + 64 / tokenfile.RANK_BITS))
            done += w
        return total
    got, bits = tokenfile.widths(ids), max(1, top.bit_length())
    assert sum(got) == bits
    assert all(cost(got) <= cost([a, bits - a]) + 1e-9 for a in range(1, bits)) and cost(got) <= cost([bits])
    assert tokenfile.widths(np.zeros(0, np.uint32)) == [1]
