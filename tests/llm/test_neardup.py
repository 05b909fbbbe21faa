from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest

from strata.llm import neardup
from strata.llm.words import shingles, spaced
from . import brute

VOCABULARY = [f"w{i}" for i in range(400)]


def _edited(rnd, words, n):
    words = list(words)
    for _ in range(n):
        words[rnd.randrange(len(words))] = rnd.choice(VOCABULARY)
    return words


def _texts():
    """Originals with copies at all distances, a big group of near copies, a chain, odd texts."""
    rnd = random.Random(8)
    texts = []
    for _ in range(25):
        words = [rnd.choice(VOCABULARY) for _ in range(rnd.choice([3, 12, 60, 150]))]
        texts += [" ".join(_edited(rnd, words, max(0, round(len(words) * e)))) for e in (0, 0, 0.01, 0.03, 0.05, 0.08, 0.3)]
    base = [rnd.choice(VOCABULARY) for _ in range(120)]
    texts += [" ".join(_edited(rnd, base, 3)) for _ in range(60)]
    for _ in range(12):  # each a little further from the first
        base = _edited(rnd, base, 3)
        texts.append(" ".join(base))
    texts += [texts[0].upper(), texts[1].replace(" ", "\n"), "", None, "  ", "one", "One", "one two", "two one", "", None]
    rnd.shuffle(texts)
    return texts


def test_groups_match_brute_force(spark):
    texts = _texts()
    docs = brute.frame(spark, [(i, t, None, None) for i, t in enumerate(texts)], clash=True)
    for k in (2, 5):
        want = brute.groups(texts, k)
        got = {r.doc_id: r for r in neardup.near_duplicates(docs, k).collect()}
        assert [got[i].component_id for i in range(len(texts))] == want
        assert [got[i].n_shingles for i in range(len(texts))] == [len(brute.shingles(t, k)) for t in texts]
        assert all(r.kept == (r.doc_id == r.component_id) for r in got.values())


@pytest.mark.parametrize("percent", [60, 80])
def test_buckets_that_hold_several_components(spark, monkeypatch, percent):
    """With one register a band almost all texts share buckets: no link may
    depend on which class is a bucket's centre, nor on how the rest is searched."""
    monkeypatch.setattr(neardup, "BAND", 1)
    texts = _texts()[:130]
    texts += [" ".join(t.split()[: len(t.split()) * 9 // 10]) for t in texts[:40] if t]
    docs = brute.frame(spark, [(i, t, None, None) for i, t in enumerate(texts)])
    got = {r.doc_id: r.component_id for r in neardup.near_duplicates(docs, 2, percent).collect()}
    assert [got[i] for i in range(len(texts))] == brute.groups(texts, 2, percent)


def _changes(spark, texts, percent=80, k=1):
    """What all texts change in the first, the centre; each is a part of its own
    unless it is linked with the centre."""
    sets = [brute.shingles(t, k) for t in texts]
    near = lambda a, b: 100 * len(a & b) >= percent * len(a | b)
    rows = [(0, x, 0 if near(sets[0], sets[x]) else x, not near(sets[0], sets[x])) for x in range(1, len(texts))]
    grouped = spark.createDataFrame(rows, "c long, x long, part long, apart boolean")
    docs = brute.frame(spark, [(i, t, None, None) for i, t in enumerate(texts)])
    return neardup.edits(grouped, neardup.full_sets(docs, spark.range(len(texts)).toDF("node"), k), percent), sets, near


def test_pairs_at_exactly_the_threshold_are_candidates(spark):
    """A centre, a class near it, one at exactly 0.8 to that but not to the
    centre, and forty others apart from the centre."""
    centre = [f"c{i}" for i in range(100)]
    near = ["b0", *centre[1:]]
    far = near + [f"a{i}" for i in range(25)]
    others = [centre + [f"o{n}_{i}" for i in range(26)] for n in range(40)]
    changes, *_ = _changes(spark, [" ".join(w) for w in (centre, near, far, *others)])
    assert {(r.a, r.b) for r in neardup.candidates(changes, 80).collect()} == {(2, 1)}


@pytest.mark.parametrize("percent", [55, 80, 95])
def test_every_link_is_a_candidate(spark, percent):
    """Random edits, shortened and lengthened copies, copies of copies."""
    rnd = random.Random(percent)
    base = VOCABULARY[:90]
    pool = [base]
    for _ in range(160):
        words = _edited(rnd, rnd.choice(pool), rnd.choice([1, 3, 8, 15]))
        kind = rnd.random()
        if kind < 0.25:
            words = words[: rnd.randint(40, 90)]
        elif kind < 0.5:
            words = words + [f"n{rnd.randrange(60)}" for _ in range(rnd.randint(1, 50))]
        pool.append(words)
    changes, sets, near = _changes(spark, [" ".join(w) for w in pool], percent)
    found = {(r.a, r.b) for r in neardup.candidates(changes, percent).collect()}
    links = {(x, y) for x in range(1, len(pool)) for y in range(1, len(pool)) if x != y and near(sets[x], sets[y])}
    apart = {x for x in range(1, len(pool)) if not near(sets[0], sets[x])}
    needed = {(x, y) for x, y in links if x in apart and (y not in apart or x < y)}
    assert needed <= found and len(needed) > 5
    got = {tuple(r) for r in neardup._linked_by_edits(changes, percent).collect()}
    assert got == needed


def test_changes_that_all_classes_share_make_no_pairs(spark):
    """Sixty classes with the same fifteen words replaced and forty own words each;
    two of them are similar to each other."""
    centre = [f"c{i}" for i in range(100)]
    common = [f"f{i}" for i in range(15)] + centre[15:]
    classes = [common + [f"o{n}_{i}" for i in range(40)] for n in range(60)]
    classes.append([*classes[7][:-4], "x", "y", "z"])
    changes, *_ = _changes(spark, [" ".join(w) for w in (centre, *classes)])
    assert changes.where("apart and first > 0").count() == 61
    assert {(r.a, r.b) for r in neardup.candidates(changes, 80).collect()} == {(8, 61)}


def _near_copies(n):
    """One text and n near copies of it, a quarter of them beyond the threshold."""
    rnd = random.Random(9)
    base = [f"v{rnd.randrange(3000)}" for _ in range(100)]
    copies = []
    for i in range(n):
        words = list(base)
        for _ in range(3 if i % 4 else 9):
            words[rnd.randrange(100)] = f"v{rnd.randrange(3000)}"
        copies.append(" ".join(words))
    return [" ".join(base), *copies]


def test_compared_pairs_grow_with_the_group_not_its_square(spark, monkeypatch):
    compared = {}
    real = neardup.candidates
    for n in (150, 300, 600):
        pairs = []
        monkeypatch.setattr(neardup, "candidates", lambda *a: pairs.append(real(*a)) or pairs[-1])
        texts = _near_copies(n)
        docs = brute.frame(spark, [(i, t, None, None) for i, t in enumerate(texts)])
        got = {r.doc_id: r.component_id for r in neardup.near_duplicates(docs, 2).collect()}
        assert [got[i] for i in range(n + 1)] == brute.groups(texts, 2)
        assert len(set(got.values())) > n // 20
        compared[n] = pairs[0].count()
    assert all(compared[n] <= n // 4 for n in compared)  # of n (n - 1) / 2


def test_a_hot_set_and_a_hot_row(spark):
    """A third of all rows hold one text, another third are one repeated row."""
    texts = _near_copies(60)
    rows = [(i, t, None, None) for i, t in enumerate(texts)] + [(1000 + i, texts[3], None, None) for i in range(60)]
    rows += [(5000, "a row that is repeated very often", None, None)] * 60
    got = {r.doc_id: r.component_id for r in neardup.near_duplicates(brute.frame(spark, rows), 2).collect()}
    want = brute.groups([t for _, t, *_ in rows], 2)
    assert all(got[rows[i][0]] == rows[w][0] for i, w in enumerate(want))


def test_rows_of_one_id_and_null_ids(spark):
    long = " ".join(VOCABULARY[:80])
    other = " ".join(VOCABULARY[100:180])
    rows = [(7, long, None, None), (7, long, None, None), (7, other, None, None), (9, other + " x", None, None), (3, long + " y", None, None), (None, "apart", None, None), (None, None, None, None)]
    got = neardup.near_duplicates(brute.frame(spark, rows), 5).collect()
    assert len(got) == len(rows)
    assert {r.component_id for r in got if r.doc_id is not None} == {3}
    assert {r.component_id for r in got if r.doc_id is None} == {None}


def test_texts_are_not_linked_by_null_or_repeated_ids(spark):
    long, other, third = (" ".join(VOCABULARY[i : i + 80]) for i in (0, 100, 200))
    rows = [(None, long, None, None), (None, other, None, None), (None, other, None, "s"), (None, None, None, None), (5, other + " x", None, None)]
    rows += [(7, third, None, None), (7, "apart", None, None), (7, "apart", None, None), (9, "", None, None), (3, third + " y", None, None)]
    kept = neardup.drop_near_duplicate_texts(brute.frame(spark, rows, clash=True))
    assert kept.columns == brute.frame(spark, rows, clash=True).columns
    want = [(None, long), (None, None), (5, other + " x"), (7, "apart"), (9, ""), (3, third + " y")]
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted(want, key=str)
    assert neardup.drop_near_duplicate_texts(brute.frame(spark, [])).count() == 0


def test_text_keys_differ(spark):
    rows = [(i, t, None, None) for i in (None, 0, 1) for t in (None, "", "a", "b")]
    docs = brute.frame(spark, rows + rows)
    assert docs.select(neardup._text_key(docs)).distinct().count() == len(rows)


def test_empty_table(spark):
    assert neardup.near_duplicates(brute.frame(spark, [])).count() == 0


def test_registers_merge_and_estimate():
    rnd = random.Random(3)
    sets = [shingles(spaced(pa.array([" ".join(rnd.choice(VOCABULARY) for _ in range(n))]))[0], 2) for n in (300, 40, 1000)]
    union = np.unique(np.concatenate(sets))
    merged = np.maximum.reduce([neardup.registers(s) for s in sets])
    assert (merged == neardup.registers(union)).all()
    many = np.unique(np.random.default_rng(1).integers(0, 2**63, 3000, dtype=np.uint64))
    for share in (0.3, 0.8, 0.95):
        n = int(1000 * share)
        a, b = many[:1000], np.concatenate([many[:n], many[2000 : 2000 + 700]])
        true = n / (1000 + len(b) - n)
        guess = neardup.likely_jaccard(neardup.registers(a), neardup.registers(b), len(a), len(b))
        assert abs(guess - true) < 5.8 * (true * (1 - true) / neardup.REGISTERS) ** 0.5
