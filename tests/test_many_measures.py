"""Measures of many pairs at a time against those of one pair."""

import random

import pytest

from kinspark.functions import metrics


def _texts(rng, n):
    words = ["oak", "hill", "st", "1234", "unit", "7", "भारत", "😀", "a", "marketing", "llc", "é"]
    some = [" ".join(rng.choices(words, k=rng.randint(0, 9))) for _ in range(n)]
    return [*some, "", "x", "ab" * 32, "ab" * 33, "q" * 64, "".join(rng.choices("abcd ", k=300)), " oak  oak ", "".join(rng.choices("abc", k=255))]


@pytest.mark.parametrize("name", sorted(metrics.MANY))
def test_many_are_as_one(name, monkeypatch):
    monkeypatch.setattr(metrics, "PAIRS", 97)
    rng = random.Random(5)
    a, b = ([rng.choice(pool) for _ in range(900)] for pool in (_texts(rng, 80), _texts(rng, 80)))
    near = [t[: rng.randint(0, len(t))] + rng.choice("ab 7") + t[rng.randint(0, len(t)) :] for t in a]
    one = metrics.MEASURES[name][0]
    for right in (b, near, a):
        assert metrics.MANY[name](a, right) == [one(x, y) for x, y in zip(a, right)]


def test_long_addresses_are_not_searched_window_by_window(monkeypatch):
    monkeypatch.setattr(metrics, "partial_ratio", None)
    monkeypatch.setattr(metrics, "_common", None)
    assert metrics.MANY["partial_ratio"](["12 oak hill"], ["unit 7 12 oak hill st"]) == [100.0]
