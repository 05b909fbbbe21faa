from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest

from strata.llm import words
from . import brute


def _texts(seed, n=60):
    rnd = random.Random(seed)
    parts = ["a", "B", "é", "ß", "日本", " ", "\n", "\t", "-", "7", "\x00", "\x7f", "|", "Word", "\u00a0"]
    return ["".join(rnd.choice(parts) for _ in range(rnd.choice([0, 1, 2, 30, 400]))) for _ in range(n)] + [None, "", "   "]


@pytest.mark.parametrize("hasher, plain", [(words.spaced, brute.spaced), (words.plain, brute.plain)])
@pytest.mark.parametrize("piece", [7, 100, 1 << 20])
def test_equal_words_and_only_those_have_equal_hashes(monkeypatch, hasher, plain, piece):
    monkeypatch.setattr(words, "PIECE", piece)
    texts = _texts(3)
    hashes, bounds = hasher(pa.array(texts, pa.string()))
    seen = {}
    for i, text in enumerate(texts):
        own = plain(text)
        assert bounds[i + 1] - bounds[i] == len(own)
        for word, h in zip(own, hashes[bounds[i] : bounds[i + 1]].tolist()):
            assert seen.setdefault(word, h) == h
    assert len(set(seen.values())) == len(seen)


def test_a_sliced_column_and_an_empty_one():
    column = pa.array(["x y", "z", None, "a b c"]).slice(1, 3)
    assert words.spaced(column)[1].tolist() == [0, 1, 1, 4]
    assert words.spaced(pa.array([], pa.string()))[1].tolist() == [0]


def test_shingle_counts_match_brute_force():
    for text in _texts(5):
        hashes, _ = words.spaced(pa.array([text], pa.string()))
        for k in (2, 5):
            assert len(words.shingles(hashes, k)) == len(brute.shingles(text, k))


def test_a_text_longer_than_a_piece():
    text = " ".join(f"w{i % 5000}" for i in range(400_000))
    assert len(text) > 2 * words.PIECE
    hashes, bounds = words.spaced(pa.array([text, "w1"]))
    assert bounds.tolist() == [0, 400_000, 400_001]
    assert len(np.unique(hashes)) == 5000 and hashes[1] == hashes[-1]


def test_short_texts_take_short_tables(monkeypatch):
    """The driver reads the benchmark alone, so it holds no tables for whole pieces."""
    kept: dict = {}
    monkeypatch.setattr(words.powers, "__defaults__", (False, kept))
    before, _ = words.plain(pa.array(["a b", "c a"]))
    assert sum(t.nbytes for t in kept.values()) < 1 << 20
    after, _ = words.plain(pa.array(["a b", "c a", "d " * 20_000]))
    assert after[:4].tolist() == before.tolist() and before[0] == before[3]


@pytest.mark.parametrize("inverse", [False, True])
def test_powers_grow_with_what_is_asked(inverse):
    kept: dict = {}
    factor = int(words._M_INVERSE if inverse else words._M)
    for n in (0, 1, 5, 4096, 4097, 70_000, 9, words.PIECE + 3):
        got = words.powers(n, inverse, kept)
        assert len(got) == n and len(kept[inverse]) <= max(n, words.PIECE)
        assert all(int(got[i]) == pow(factor, i, 2**64) for i in {0, 1, n // 2, n - 1} if 0 <= i < n)
