from __future__ import annotations

import random

from pyspark.sql import functions as F

from strata.llm.mixture import mix, sainte_lague
from . import brute


def _targets(sizes, weights=(1, 2, 3), cap=3):
    """Sources in order; the excess over a cap is shared again until there is none."""
    total, n = sum(sizes), len(sizes)
    w = [weights[i % len(weights)] for i in range(n)]
    capped = [False] * n
    while True:
        rest = total - sum(cap * s for s, c in zip(sizes, capped) if c)
        free = sum(x for x, c in zip(w, capped) if not c) or 1
        target = [cap * s if c else rest * x / free for s, x, c in zip(sizes, w, capped)]
        over = [not c and t > cap * s for t, s, c in zip(target, sizes, capped)]
        if not any(over):
            return target
        capped = [c or o for c, o in zip(capped, over)]


def _docs(seed=4):
    rnd = random.Random(seed)
    rows = [(i, " ".join(["w"] * rnd.randint(0, 300)), None, rnd.choice("aaaaaabbcdé")) for i in range(400)]
    return rows + [(1000 + i, "tiny text", None, "zz") for i in range(3)] + [(2000, None, None, "e"), (2001, "two words", None, None), (2001, "two words", None, None), (None, "x y z", None, "a")]


def test_targets_taken_and_limits(spark):
    rows = _docs()
    for per_shard in (4000, 50):
        got = mix(brute.frame(spark, rows, clash=True), block_tokens=8, docs_per_shard=per_shard).collect()
        assert len(got) == len(rows)
        size_of = {}
        for _, t, _, s in rows:
            size_of[s] = size_of.get(s, 0) + len(brute.spaced(t))
        names = sorted((s for s in size_of if s is not None)) + [None]
        want = dict(zip(names, _targets([size_of[s] for s in names])))
        source = {r[0]: r[3] for r in rows}
        taken = dict.fromkeys(names, 0)
        for r in got:
            s = source[r.doc_id]
            assert r.source_size == size_of[s] and abs(r.target - want[s]) < 1e-6
            assert 0 <= r.taken <= 3 * r.size and 0 <= r.copies <= 3
            taken[s] += r.taken
        shards = len(rows) // per_shard + 1
        assert all(abs(taken[s] - want[s]) <= 8 * shards for s in names), (taken, want)


def test_small_sources_of_short_texts_come_near_their_targets(spark):
    """However many shards a table has: a source with one document a shard, one
    that is taken once, and one whose texts are mostly empty."""
    rows = [(i, " ".join(["w"] * 100), None, "a") for i in range(600)]
    rows += [(1000 + i, " ".join(["w"] * 10), None, "b") for i in range(100)]
    rows += [(2000 + i, "w w w" if i % 10 == 0 else "", None, "c") for i in range(100)]
    for per_shard, weights in ((4000, (1, 2, 3)), (8, (1, 2, 3)), (8, (1, 0.02, 0.001))):
        got = mix(brute.frame(spark, rows), weights, docs_per_shard=per_shard).collect()
        assert len(got) == len(rows)
        for lo, hi, size, want in zip((0, 1000, 2000), (600, 1100, 2100), (60000, 1000, 30), _targets([60000, 1000, 30], weights)):
            own = [r for r in got if lo <= r.doc_id < hi]
            assert {(r.source_size, r.size == 0 and r.taken > 0) for r in own} == {(size, False)}
            assert abs(sum(r.taken for r in own) - want) <= 64, (per_shard, weights, want)
            if lo == 1000 and want == 3 * size:
                assert sum(r.copies for r in own) >= 3 * len(own) - 7
            assert all(r.taken <= 3 * r.size for r in own)
    once = [r.taken / r.size for r in got if 1000 <= r.doc_id < 1100]
    assert max(once) - min(once) <= 1


def test_reruns_agree(spark):
    docs = brute.frame(spark, _docs())
    runs = [sorted((r.doc_id or -1, r.size, r.taken, r.copies) for r in mix(d, docs_per_shard=60).collect()) for d in (docs, docs.repartition(5, "text"))]
    assert runs[0] == runs[1]


def test_whole_rows_are_kept_under_clashing_names(spark):
    docs = brute.frame(spark, _docs()[:50], clash=True)
    got = mix(docs, keep_rows=True).select("doc_id", "row.*")
    assert got.columns == ["doc_id", *docs.columns]
    assert got.count() == 50


def test_empty_and_wordless_tables(spark):
    assert mix(brute.frame(spark, [])).count() == 0
    got = mix(brute.frame(spark, [(1, None, None, "a"), (2, "", None, None)])).collect()
    assert [(r.size, r.target, r.taken) for r in got] == [(0, 0.0, 0)] * 2


def _highest_quotients(votes, seats):
    quotients = sorted(((-v / (2 * k - 1), i) for i, v in enumerate(votes) if v for k in range(1, seats + 1)))[:seats]
    return [sum(i == j for _, j in quotients) for i in range(len(votes))]


def test_apportionment_matches_the_highest_quotients(spark):
    rnd = random.Random(9)
    groups = [([rnd.choice([0, 1, 5, 1000, rnd.randint(1, 10**6)]) for _ in range(rnd.randint(1, 12))], rnd.randint(0, 300)) for _ in range(40)]
    groups = [g for g in groups if sum(g[0])]
    rows = [(g, i, v, n) for g, (votes, n) in enumerate(groups) for i, v in enumerate(votes)]
    got = sainte_lague(spark.createDataFrame(rows, "g int, i int, v long, n long"), ["g"], "v", "n", ["i"]).orderBy("g", "i").collect()
    for g, (votes, n) in enumerate(groups):
        assert [r.quota for r in got if r.g == g] == _highest_quotients(votes, n)


def test_seats_go_to_the_parties_that_win_them(spark):
    """As for sources: one group, in the order of ``_rank``."""
    votes = [57940, 3000, 90]
    parties = spark.createDataFrame([(i, v, 954) for i, v in enumerate(votes)], "_rank int, v long, n long")
    got = {r._rank: r.quota for r in sainte_lague(parties, [], "v", "n", ["_rank"]).collect()}
    assert [got[i] for i in range(3)] == _highest_quotients(votes, 954)


def test_no_python_in_the_plan(spark):
    plan = mix(brute.frame(spark, _docs()).withColumn("x", F.lit(1)))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan
