"""Words segmented together have the pieces that each has on its own."""

import random

import numpy as np
import pytest

from eventide.llm import pieces
from eventide.llm.queries import PIECES


@pytest.mark.parametrize("cells", [1, 40, 1 << 16])
def test_words_together_and_apart(cells):
    p, r = pieces.load(PIECES), random.Random(5)
    words = {pieces.SPACE * r.randint(0, 2) + "".join(r.choices("aeinrst,.X1éß中🙂\x00\ud800", k=r.randint(1, 12))) for _ in range(800)}
    got = pieces.segment(p, sorted(words), cells)
    assert got == {w: np.array(pieces._long(p, w), "<u4").tobytes() for w in words}
    assert pieces.segment(p, []) == {}


def test_most_substrings_are_not_searched(monkeypatch):
    p, r, searched, search = pieces.load(PIECES), random.Random(6), [], np.searchsorted

    def counted(a, v, *rest, **kw):
        searched.append(np.size(v))
        return search(a, v, *rest, **kw)
    monkeypatch.setattr(np, "searchsorted", counted)
    words = sorted({pieces.SPACE + "".join(r.choices("abcdefghijklmnopqrstuvwxyz", k=11)) for _ in range(500)})
    got = pieces.segment(p, words)
    assert sum(searched) < sum(len(w) * (len(w) + 1) // 2 for w in words) / 2
    assert [pieces.decode(p, np.frombuffer(got[w], "<u4")) for w in words] == [w[1:] for w in words]
