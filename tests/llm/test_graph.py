from __future__ import annotations

import random

from strata.llm import graph
from strata.llm.graph import components


def _slow(links):
    root = {}
    find = lambda x: x if root.setdefault(x, x) == x else find(root[x])
    for a, b in links:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {x: find(x) for x in root if any(x in l and l[0] != l[1] for l in links)}


def test_components_match_union_find(spark):
    rnd = random.Random(6)
    links = [(rnd.randint(0, 120), rnd.randint(0, 120)) for _ in range(90)]
    links += [(1000 + i, 1001 + i) for i in range(40)]  # a chain
    links += [(2000, 2001 + i) for i in range(50)] + [(2050, 2100 + i) for i in range(50)]  # two stars, joined
    links += [(5, 5), links[0], links[0][::-1]]
    rnd.shuffle(links)
    got = components(spark.createDataFrame(links, "a long, b long")).collect()
    assert len({r.node for r in got}) == len(got)
    assert {r.node: r.component for r in got} == _slow(links)


def test_no_links(spark):
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_links_that_are_stars_take_no_round(spark, monkeypatch):
    """An earlier result is joined further without beginning again."""
    written, cut = [], graph.cut_lineage
    monkeypatch.setattr(graph, "cut_lineage", lambda df: written.append(1) or cut(df))
    stars = [(i, 0) for i in range(1, 9)] + [(i, 20) for i in range(21, 25)]
    got = {r.node: r.component for r in components(spark.createDataFrame(stars, "a long, b long")).collect()}
    assert got == _slow(stars) and len(written) == 1
    joined = [*stars, (24, 8)]
    assert {r.node: r.component for r in components(spark.createDataFrame(joined, "a long, b long")).collect()} == _slow(joined)
    assert len(written) <= 5


def test_a_round_reads_its_links_once(spark):
    """Both ends of a link come from one task, not from one for each end."""
    edges = spark.createDataFrame([(i, i // 2) for i in range(1, 40)], "a long, b long").repartition(5)
    ends = graph._both_ends(edges)
    assert ends.rdd.getNumPartitions() == 5
    assert sorted(map(tuple, ends.collect())) == sorted([(i, i // 2) for i in range(1, 40)] + [(i // 2, i) for i in range(1, 40)])
