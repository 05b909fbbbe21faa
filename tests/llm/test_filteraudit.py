from __future__ import annotations

import random
import re
from itertools import permutations

import numpy as np

from strata.llm.filteraudit import FILTERS, filter_audit, order_intervals, removals
from strata.llm.words import word_pieces
from . import brute


def plain_audit(rows, labels):
    """Every order applied filter by filter."""
    good = {d for d, q, _ in labels if d is not None and q == 1}
    toxic = {d for d, _, x in labels if d is not None and x == 1}
    judged = []
    for doc_id, text, _, source in rows:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = {
            "A": len(words) < 200,
            "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 2 * len(text),
            "D": bool(re.search(r"[#$%&*|]", text)),
            "E": doc_id is not None and any(d is not None and d < doc_id and (t or "") == text for d, t, *_ in rows),
        }
        judged.append((source or "", {f for f, x in fails.items() if x}, doc_id in good, doc_id in toxic))
    out = []
    for part in {j[0] for j in judged}:
        own, sums = [j for j in judged if j[0] == part], dict.fromkeys(FILTERS, 0)
        for order in permutations(FILTERS):
            left = own
            for step, f in enumerate(order, 1):
                gone, left = [j for j in left if f in j[1]], [j for j in left if f not in j[1]]
                sums[f] += len(gone)
                failing = [j for j in own if f in j[1]]
                out.append([
                    part, "".join(order), step, len(left), len(gone), len(failing) - len(gone), sum(j[1] == {f} for j in own),
                    sum(j[2] for j in gone), sum(j[3] for j in gone), f,
                ])
        for row in out:
            if row[0] == part:
                row[9] = sums[row[9]]
    return sorted(map(tuple, out))


def test_intervals_of_a_mask_hold_every_order_once():
    per_mask = {}
    for mask, step, low, high in order_intervals():
        assert low < high
        per_mask.setdefault(mask, []).extend(range(low, high))
    assert {m: sorted(r) for m, r in per_mask.items()} == {m: list(range(120)) for m in range(1, 32)}
    counts = np.random.default_rng(1).integers(0, 2**50, (32, 1))
    gone = removals(counts)
    for rank, order in enumerate(permutations(range(5))):
        for mask in range(1, 32):
            step = next(s for s, i in enumerate(order) if mask >> i & 1)
            gone[step, rank] -= counts[mask]
    assert not gone.any()


def test_words_of_any_piece_size():
    rnd = random.Random(1)
    for _ in range(500):
        text = "".join(rnd.choice("ab \n\t") for _ in range(rnd.randint(0, 40))).encode()
        for size in (1, 2, 3, 7, 100):
            assert [w for words in word_pieces(text, None, size) for w in words] == text.split()


def _rows(seed, n):
    rnd = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)] + ["A", "B&B", "UPPER", "日本", "x#"]
    texts = [None, "", " ", "AB ab", "$"]
    for _ in range(40):
        some = rnd.sample(vocabulary, rnd.choice([2, 20, 305]))
        texts.append(rnd.choice([" ", "\n", " \x0b"]).join(rnd.choice(some) for _ in range(rnd.choice([5, 199, 200, 260]))))
    rows = [(rnd.randrange(n), rnd.choice(texts), None, rnd.choice(["a", "b", "", None, "only " + str(rnd.randrange(3))])) for _ in range(n)]
    return rows + rows[:3] + [(None, texts[5], "en", "a"), (None, texts[5], "en", None), (-5, texts[6], None, "a")]


def test_every_order_equals_filtering(spark):
    rnd = random.Random(8)
    rows = _rows(8, 160)
    labels = [(d, rnd.choice([0, 1, None]), rnd.choice([0, 1, None])) for d in range(0, 200, 2)] + [(4, 1, 1), (None, 1, 1)]
    told = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = filter_audit(brute.frame(spark, rows, clash=True), told)
    assert sorted(map(tuple, got.collect())) == plain_audit(rows, labels)


def test_one_text_and_one_id_for_many_rows(spark):
    """A third of the rows hold one text, a third one id and a third no id."""
    rows = [(i, "one text of all", None, "hot") for i in range(100)] + [(7, f"text {i}", None, None) for i in range(100)]
    rows += [(None, "one text of all", None, "hot")] * 100
    told = spark.createDataFrame([(7, 1, 0)], "doc_id long, quality int, toxic int")
    got = filter_audit(brute.frame(spark, rows), told)
    assert sorted(map(tuple, got.collect())) == plain_audit(rows, [(7, 1, 0)])


def test_no_rows(spark):
    told = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit(brute.frame(spark, []), told).count() == 0
    rows = [(1, "a b", None, None)]
    assert filter_audit(brute.frame(spark, rows), told).count() == 600
    assert sorted(map(tuple, filter_audit(brute.frame(spark, rows), told).collect())) == plain_audit(rows, [])


def test_a_very_long_text(spark):
    rows = [(1, "word other " * 300_000, None, "a"), (2, "x" * 3_000_000, None, "a"), (3, " ".join(map(str, range(300_000))), None, "a")]
    told = spark.createDataFrame([(2, 0, 1)], "doc_id long, quality int, toxic int")
    assert sorted(map(tuple, filter_audit(brute.frame(spark, rows), told).collect())) == plain_audit(rows, [(2, 0, 1)])
