from __future__ import annotations

import hashlib
import random

from strata.llm.common import read_table
from strata.llm.fingerprint import BINS, fingerprint_edits, op4_fingerprints, succession
from . import brute
from ..conftest import SF_SMALL


def _jaccard(a, b):
    a, b = brute.shingles(a, 5), brute.shingles(b, 5)
    return len(a & b) / max(1, len(a | b))


def _check(rows, got):
    """rows: (doc_id, text) in order, one row each."""
    errors = []
    by_id = {r.doc_id: r for r in got}
    for i, (doc, text) in enumerate(rows):
        text, following = text or "", rows[(i + 1) % len(rows)][1] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        r = by_id[doc]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        assert len(r.fingerprint) == (BINS if brute.spaced(text) else 0)
        if len(brute.shingles(text, 5)) > 50 and len(brute.shingles(following, 5)) > 50:
            errors += [abs(r.near_edited - _jaccard(text, edited)), abs(r.near_next - _jaccard(text, following))]
    return errors


def test_all_documents_of_the_table(spark):
    rows = sorted((r.doc_id, r.text) for r in read_table(spark, SF_SMALL, "documents").select("doc_id", "text").collect())
    errors = _check(rows, op4_fingerprints(spark, SF_SMALL).collect())
    assert sum(errors) / len(errors) < 0.03 and max(errors) < 0.2


def test_odd_texts(spark):
    rnd = random.Random(2)
    long = " ".join(rnd.choice("abcdefgh") * rnd.randint(1, 5) for _ in range(60_000))
    rows = [(-5, None), (0, ""), (1, "  "), (2, "a"), (3, "A"), (4, "a b c"), (5, "é日本 ß" * 40), (6, long), (7, long), (100, "x y z w v u")]
    got = fingerprint_edits(brute.frame(spark, [(*r, None, None) for r in rows], clash=True)).collect()
    _check(rows, got)
    by_id = {r.doc_id: r for r in got}
    assert by_id[6].fingerprint == by_id[7].fingerprint and by_id[6].near_next == 1.0
    assert by_id[2].fingerprint == by_id[3].fingerprint != by_id[4].fingerprint
    assert (by_id[-5].near_next, by_id[1].near_next) == (1.0, 0.0)


def test_repeated_rows_single_row_no_row(spark):
    rows = [(1, "one two three four five six"), (1, "one two three four five six"), (1, "other text of the same id"), (None, "no id"), (2, "b")]
    got = fingerprint_edits(brute.frame(spark, [(*r, None, None) for r in rows])).collect()
    assert len(got) == len(rows)
    assert len({tuple(r) for r in got}) == 4
    alone = fingerprint_edits(brute.frame(spark, [(4, "just this text, twice", None, None)])).first()
    assert alone.near_next == 1.0
    assert fingerprint_edits(brute.frame(spark, [])).count() == 0


def test_succession_over_many_ranges(spark):
    rnd = random.Random(5)
    ids = rnd.sample(range(-(10**9), 10**9), 3000)
    df = spark.createDataFrame([(i, 0, i % 7) for i in ids], "_id long, _tie long, _n int")
    order = sorted(ids)
    got = {r._id: (r._before, r._before_n) for r in succession(df).collect()}
    assert got == {b: (a, a % 7) for a, b in zip([order[-1], *order], order)}


def test_no_python_in_the_plan(spark):
    plan = fingerprint_edits(brute.frame(spark, [(1, "a", None, None)]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
