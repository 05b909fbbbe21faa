from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import pytest

from strata.llm import divergence
from strata.llm.divergence import source_divergence, text_terms
from . import brute

TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
_LOWER = {i: i + 32 for i in range(65, 91)}


def plain_divergence(rows, min_docs=10, top=10):
    groups, docs, whole = defaultdict(Counter), Counter(), defaultdict(Counter)
    for _, text, lang, source in rows:
        lang, words = lang or "", re.findall(TERM, (text or "").translate(_LOWER))
        groups[lang, source or ""].update(words)
        whole[lang].update(words)
        docs.update((lang, w) for w in set(words))
    share = lambda n, total, v: 1 + 10**9 * (n + 2) // (total + 2 * v)
    gap = lambda p, q: (p - q) ** 2 // (p + q)
    out = []
    for (lang, source), own in groups.items():
        kept = [w for w in whole[lang] if docs[lang, w] >= min_docs]
        p = lambda c: {w: share(c[w], sum(c[x] for x in kept), len(kept)) for w in kept}  # noqa: B023, E731
        mine, every = p(own), p(whole[lang])
        pairs = []
        for (other_lang, other), counts in groups.items():
            if other_lang == lang and other != source:
                theirs = p(counts)
                pairs.append((-sum(gap(mine[w], theirs[w]) for w in kept), other.encode()))
        terms = [(-gap(mine[w], every[w]), w.encode()) for w in kept if own[w] and mine[w] > every[w]]
        for part, found in (("pair", sorted(pairs)), ("term", sorted(terms)[:top])):
            out += [(lang, source, part, item.decode(), -value, rank) for rank, (value, item) in enumerate(found, 1)]
    return sorted(out)


def _rows(seed, n):
    rnd = random.Random(seed)
    vocabulary = [f"{a}{b}" for a in ("ab", "Cd", "é", "日") for b in ("x", "yy", "Z", "ß", "q")]
    texts = [None, "", "123 45", *(" ".join(rnd.choice(vocabulary) for _ in range(rnd.choice([1, 5, 30]))) for _ in range(n // 3))]
    source = lambda: rnd.choice(["web", "books", "code", None, "", "é", "z9"])
    return [(i, rnd.choice(texts), rnd.choice(["en", "en", "de", None, "few" if i % 40 == 0 else ""]), source()) for i in range(n)]


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_a_dense_plain_version(spark, seed):
    rows = _rows(seed, 260)
    rows += rows[:5] + [(9000 + i, "copied Text of all sources", "en", f"s{i % 3}") for i in range(120)] + [(1, None, "fr", "alone"), (2, "!!", "it", None)]
    got = source_divergence(brute.frame(spark, rows, clash=True))
    assert got.schema.simpleString() == "struct<lang:string,source:string,part:string,item:string,value:bigint,rank:int>"
    assert sorted(map(tuple, got.collect())) == plain_divergence(rows)


def test_without_broadcast_and_in_many_small_sends(spark, monkeypatch):
    rows = _rows(3, 200)
    monkeypatch.setattr(divergence, "MAX_BROADCAST", 0)
    monkeypatch.setattr(divergence, "HELD", 3)
    assert sorted(map(tuple, source_divergence(brute.frame(spark, rows), 3, 4).collect())) == plain_divergence(rows, 3, 4)


def test_a_text_is_cut_into_terms_once(spark):
    rows = [(i, "one two", "en", "a" if i % 2 else "b") for i in range(50)] + [(99, "three", "en", "a")]
    found = divergence.collapsed(brute.frame(spark, rows)).collect()
    assert sorted((r.text, sorted(map(tuple, r.sources))) for r in found) == [("one two", [("a", 25), ("b", 25)]), ("three", [("a", 1)])]


def test_no_kept_term_and_no_rows(spark):
    rows = [(i, f"w{chr(97 + i)}", "en", s) for i, s in enumerate(["b", "a", "c"])]
    got = sorted(map(tuple, source_divergence(brute.frame(spark, rows)).collect()))
    assert got == plain_divergence(rows) and {r[4] for r in got} == {0}
    assert source_divergence(brute.frame(spark, [])).count() == 0


def test_long_texts_and_terms(spark):
    long = ["x" * 2_500_000, "Aa " * 900_000, "é" * 1_300_000 + " b"]
    for text in long:
        assert text_terms(text.encode()) == Counter(w.encode() for w in re.findall(TERM, text.translate(_LOWER)))
    rows = [(i, t, "en", f"s{i}") for i, t in enumerate(long)]
    assert sorted(map(tuple, source_divergence(brute.frame(spark, rows), 1).collect())) == plain_divergence(rows, 1)
