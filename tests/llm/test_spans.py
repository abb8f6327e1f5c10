"""Spans of windows that share a minimiser, against a plain scan of each window."""

import random

import numpy as np
import pytest

from faultline.llm import repeats


def scanned(order, width):
    """(first, number, order value) of runs of windows with the same leftmost smallest gram."""
    places = [min(range(i, i + width), key=lambda j: (order[j], j)) for i in range(len(order) - width + 1)]
    starts = [i for i in range(len(places)) if not i or places[i] != places[i - 1]]
    return [(a, b - a, order[places[a]]) for a, b in zip(starts, [*starts[1:], len(places)])]


@pytest.mark.parametrize("unit", [repeats.Bytes(window=12, gram=5), repeats.Words(window=9, gram=3)])
def test_spans_equal_a_scan(unit):
    rng = random.Random(8)
    for letters in ("a", "ab", "abcdefgh"):
        for size in (0, 3, 12, 13, 200):
            content = b" ".join(rng.choice(letters).encode() for _ in range(size))
            grams = unit.grams(content)
            frequent = np.unique(grams[::3])
            order = [int(g) >> 1 | (int(g in frequent) << 63) for g in grams]
            got = zip(*(x.tolist() for x in repeats.spans(unit, content, frequent, repeats.marks(frequent))))
            assert list(got) == (scanned(order, unit.window - unit.gram + 1) if len(order) > unit.window - unit.gram else [])


def test_few_grams_are_looked_up(monkeypatch):
    """Only grams that may be frequent are looked up in the list of the frequent ones."""
    rng = np.random.default_rng(8)
    content, frequent = rng.integers(1, 128, 20_000, np.uint8).tobytes(), np.unique(rng.integers(0, 1 << 63, 1000).astype(np.uint64))
    looked_up, plain = [], np.searchsorted
    monkeypatch.setattr(np, "searchsorted", lambda a, v: looked_up.append(len(v)) or plain(a, v))
    marked = [repeats.marks(frequent)] if hasattr(repeats, "marks") else []
    repeats.spans(repeats.Bytes(), content, frequent, *marked)
    assert sum(looked_up) < 1000
