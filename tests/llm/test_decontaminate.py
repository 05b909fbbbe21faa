from __future__ import annotations

import random

from strata.llm import decontaminate
from . import brute

ITEMS = "item_id long, text string, note string"


def _case(seed=3):
    rnd = random.Random(seed)
    vocabulary = ["the", "of"] * 20 + [f"t{i}" for i in range(60)]
    words = lambda n: [rnd.choice(vocabulary) for _ in range(n)]
    items = [(i, " ".join(words(rnd.choice([1, 2, 9, 10, 11, 40]))).upper(), "x") for i in range(30)]
    items += [(40, None, "x"), (41, "", "x"), (42, "!!", "x"), (None, "the of the", "x"), (5, "another text of item five here", "x"), (43, "the " * 25, "x"), (44, "unseen-word only", "x")]
    texts = [" ".join(words(rnd.choice([0, 5, 50, 300]))) for _ in range(60)]
    for _ in range(60):
        w = rnd.choice([i for i in items if i[1]])[1].split()
        a = rnd.randrange(len(w))
        texts.append(" ".join([*words(rnd.randint(0, 20)), *w[a : a + rnd.choice([9, 10, 12, 40])], *words(rnd.randint(0, 20))]))
    texts += [None, "", "the " * 300, "...", "THE-of,the", " ".join(words(40_000))]
    return texts, items


def _check(spark, texts, items, **kw):
    docs = brute.frame(spark, [(i, t, None, None) for i, t in enumerate(texts)], clash=True)
    got = decontaminate.leaks(docs, spark.createDataFrame(items, ITEMS), **kw).collect()
    want = brute.leaks(texts, [i[:2] for i in items])
    by_id = {r._id: (r.n_words, sorted(r.hits), r["items"]) for r in got}
    assert len(got) == len(texts)
    assert [by_id[i] for i in range(len(texts))] == want
    return got


def test_hits_match_brute_force(spark):
    texts, items = _case()
    got = _check(spark, texts, items)
    assert all(r.n_near >= len([i for i in r["items"]]) - 1 for r in got)


def test_a_benchmark_in_blocks_gives_the_same(spark):
    _check(spark, *_case(4), block_bytes=1500)


def test_repeated_rows_and_null_ids(spark):
    text = " ".join(f"k{i}" for i in range(12))
    docs = brute.frame(spark, [(1, text, None, None), (1, text, None, None), (1, "clean", None, None), (None, text, None, None)], clash=True)
    items = spark.createDataFrame([(7, text, "")], ITEMS)
    for block_bytes in (1 << 20, 100):
        got = decontaminate.leaks(docs, items, block_bytes=block_bytes).collect()
        assert sorted(len(r.hits) for r in got) == [0, 12, 12, 12]
    clean = decontaminate.clean_documents(docs, items)
    assert clean.columns == docs.columns and [r.text for r in clean.collect()] == ["clean"]


def test_empty_benchmark_and_empty_documents(spark):
    texts, items = _case()
    _check(spark, texts[:20], items[30:33])
    assert decontaminate.leaks(brute.frame(spark, []), spark.createDataFrame(items, ITEMS)).count() == 0
    assert decontaminate.leaks(brute.frame(spark, []), spark.createDataFrame([], ITEMS)).count() == 0


def test_proximity_matches(spark):
    item = " ".join(f"p{i}" for i in range(12))
    spread = item.replace("p3 ", "p3 filler ")
    docs = brute.frame(spark, [(1, "so " + spread, None, None), (2, "p1 " + "x " * 50 + "p9", None, None), (3, "p1", None, None)])
    got = {r._id: r for r in decontaminate.leaks(docs, spark.createDataFrame([(1, item, "")], ITEMS)).collect()}
    assert (got[1].n_near, len(got[1].hits)) == (1, 0)
    assert got[2].n_near == 0 and got[3].n_near == 0
