"""Names of a suffix array sorted by prefix doubling."""

from __future__ import annotations

import numpy as np
import pytest

from ledgerloom.llm import suffixarray


@pytest.mark.parametrize("symbols", [1, 2, 5, 1 << 40])
def test_names_are_sorted_as_whole_suffixes(symbols):
    random = np.random.default_rng(3)
    for n in (1, 2, 7, 50, 300):
        names = random.integers(1, symbols + 1, n)
        assert suffixarray._by_doubling(names).tolist() == sorted(range(n), key=lambda i: names[i:].tolist())


def test_names_are_not_induced_place_by_place(monkeypatch):
    random = np.random.default_rng(5)
    once = random.integers(1, 5, 40_000)
    text = np.append(np.tile(once, 3), 0)

    def refused(*_):
        raise AssertionError("names were induced place by place")

    monkeypatch.setattr(suffixarray, "_induce_one_by_one", refused)
    order = suffixarray.suffix_array(text)
    raw = text.astype(np.uint8).tobytes()
    assert sorted(order.tolist()) == list(range(len(text)))
    assert all(raw[a:] < raw[b:] for a, b in zip(order[:-1:53].tolist(), order[1::53].tolist()))
