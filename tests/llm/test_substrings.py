from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest

from strata.llm import substrings
from strata.llm.suffixes import adjacent_prefixes, eights, joined, suffix_array
from . import brute


@pytest.mark.parametrize("alphabet", [b"ab", b"a", bytes(range(256)), b"abcabcabcz"])
def test_suffix_array_matches_sorting(alphabet):
    rnd = random.Random(len(alphabet))
    for depth in (14, 100):
        strings = [bytes(rnd.choice(alphabet) for _ in range(rnd.choice([0, 1, 5, 130]))) for _ in range(12)]
        text, starts = joined(strings)
        key = eights(text)
        order = suffix_array(text, key, depth)
        assert sorted(order.tolist()) == list(range(len(text)))
        ends = np.flatnonzero(text == 0)
        upto = lambda p: text[p : min(ends[np.searchsorted(ends, p)] + 1, p + depth)].tolist()
        suffixes = [upto(p) for p in order if text[p]]
        assert suffixes == sorted(suffixes)
        whole = [p for p in order if text[p] and ends[np.searchsorted(ends, p)] - p >= depth]
        lcp = adjacent_prefixes(key, np.array(whole, np.int64), depth)
        assert [x >= depth for x in lcp] == [upto(a) == upto(b) for a, b in zip(whole, whole[1:])]


def _texts():
    rnd = random.Random(12)
    words = lambda n: " ".join(rnd.choice(["the", "of", "é", "alpha", "beta", "gamma", "日本", "x1", "zz"]) for _ in range(n))
    line, passage = words(30), words(200)
    texts = [words(rnd.randint(0, 120)) for _ in range(40)]
    texts += [words(20) + passage + words(20) for _ in range(6)] + [words(rnd.randint(0, 9)) + line + words(rnd.randint(0, 9)) for _ in range(30)]
    texts += [texts[3], texts[3], texts[50], (line + "\n") * 8, "a" * 500, "a" * 300, "ab" * 200, "short", "short", "", None, "x" * 100, "x" * 99, "x" * 100]
    texts += [passage[:150], passage[40:260], words(5000)]
    rnd.shuffle(texts)
    return texts


def _check(got, texts):
    by_id = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got}
    assert [by_id[i] for i in range(len(texts))] == brute.removed(texts)


def test_removed_bytes_match_brute_force(spark):
    texts = _texts()
    docs = brute.frame(spark, [(i, t, None, None) for i, t in enumerate(texts)], clash=True).repartition(4)
    _check(substrings.repeated_substrings(docs).collect(), texts)


def test_windows_of_hot_anchors_by_digest(spark):
    texts = _texts()
    docs = brute.frame(spark, [(i, t, None, None) for i, t in enumerate(texts)])
    _check(substrings.repeated_substrings(docs, hot_pieces=0).collect(), texts)
    _check(substrings.repeated_substrings(docs, hot_pieces=3).collect(), texts)


def test_texts_longer_than_a_stretch(spark, monkeypatch):
    monkeypatch.setattr(substrings, "_PIECE", 700)
    texts = _texts()
    docs = brute.frame(spark, [(i, t, None, None) for i, t in enumerate(texts)])
    _check(substrings.repeated_substrings(docs).collect(), texts)


def test_repeated_rows_null_ids_and_no_rows(spark):
    long = "".join(chr(97 + i % 23) + str(i) for i in range(100))
    rows = [(5, long), (5, long), (2, long[:200] + "tail"), (None, long[100:]), (5, "other " + long), (9, None)]
    got = substrings.repeated_substrings(brute.frame(spark, [(*r, None, None) for r in rows])).collect()
    assert len(got) == len(rows)
    assert [r.n_removed for r in got if r.doc_id is None] == [0]
    assert len({tuple(r) for r in got if r.doc_id == 5 and r.n_bytes == len(long)}) == 1
    assert substrings.repeated_substrings(brute.frame(spark, [])).count() == 0


def test_texts_of_one_id_keep_apart(spark):
    """Many texts without an id, two of which have one CRC-32 in their low 24 bits."""
    import zlib

    seen, pair = {}, None
    for i in range(20_000):
        text = f"text {i} of no id" + "y" * (i % 7)
        tie = zlib.crc32(text.encode()) % 2**24
        if tie in seen and seen[tie] != text:
            pair = seen[tie], text
            break
        seen[tie] = text
    line = "".join(chr(97 + i % 23) + str(i) for i in range(60))
    texts = [*pair, *(f"{i} " + line for i in range(20)), line]
    rows = [(None, t, None, None) for t in texts] + [(3, line, None, None), (3, pair[0], None, None)]
    got = substrings.repeated_substrings(brute.frame(spark, rows)).collect()
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is not None, rows[i][0] or 0, hashlib.md5(rows[i][1].encode()).digest()))
    want = brute.removed([rows[i][1] for i in order])
    assert sorted((r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == sorted(want)


def test_texts_are_dealt_out_by_digest_alone(spark, capsys):
    """What is found goes to the texts; these are not dealt out again by number."""
    docs = brute.frame(spark, [(i, t, None, None) for i, t in enumerate(_texts())])
    substrings.repeated_substrings(docs).explain("formatted")
    moved = [b for b in capsys.readouterr().out.split("\n\n") if re.match(r"\(\d+\) Exchange\n", b.strip()) and "_text#" in b]
    assert all("hashpartitioning(_md5#" in b for b in moved), moved


def test_equal_windows_have_equal_anchors():
    rnd = random.Random(1)
    shared = bytes(rnd.choice(b"abcdef") for _ in range(400))
    a, b = b"12345" + shared, b"z" * 60 + shared + b"end"
    data, bounds = np.frombuffer(a + b, np.uint8), np.array([0, len(a), len(a) + len(b)])
    of, first, more, anchor, piece = substrings.pieces(data, bounds)
    windows = {}
    for t, f, m, k in zip(of, first, more, anchor):
        for p in range(f, f + m + 1):
            windows.setdefault((a, b)[t][p : p + 100], set()).add(int(k))
    assert all(len(k) == 1 for k in windows.values())
    assert sum(more + 1) == len(a) + len(b) - 2 * 99
