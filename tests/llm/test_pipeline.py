from __future__ import annotations

import re
from collections import Counter

import pytest

import corpus_pipeline
from strata.llm.common import read_table
from . import brute
from .test_mixture import _targets
from ..conftest import SF_SMALL


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    docs, out = read_table(spark, SF_SMALL, "documents"), []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path_factory.mktemp("stage") / str(i))
        stage(spark, docs, SF_SMALL).write.parquet(path)
        out.append((docs, spark.read.parquet(path)))
        docs = out[-1][1]
    return out


def _rows(df):
    return sorted(tuple(r) for r in df.select("doc_id", "text", "source").collect())


def test_stages_keep_the_columns_of_documents(spark, stages):
    columns = read_table(spark, SF_SMALL, "documents").columns
    assert [len(corpus_pipeline.STAGES), *(after.columns for _, after in stages[:-1])] == [5, *[columns] * 4]


def test_language_keeps_documents_with_letters(stages):
    before, after = map(_rows, stages[0])
    assert after == [r for r in before if re.search(r"[^\W\d_]", r[1] or "")]


def test_one_of_each_group_stays(stages):
    before, after = map(_rows, stages[1])
    group = brute.groups([t for _, t, _ in before], 5)
    assert after == [r for i, r in enumerate(before) if group[i] == i]


def test_documents_without_an_id_stay_if_their_texts_differ(spark):
    texts = [" ".join(f"t{n}w{i}" for i in range(30)) for n in range(6)]
    docs = brute.frame(spark, [(None if n % 2 else n, t, None, None) for n, t in enumerate(texts)] + [(None, texts[0], None, None)])
    got = corpus_pipeline.drop_near_duplicates(spark, docs, SF_SMALL)
    assert Counter(_rows_of(got)) == Counter((None if n % 2 else n, t) for n, t in enumerate(texts))


def _rows_of(df):
    return [(r.doc_id, r.text) for r in df.collect()]


def test_leaks_go_and_clean_documents_stay(spark, stages):
    before, after = map(_rows, stages[2])
    items = [tuple(r) for r in read_table(spark, SF_SMALL, "benchmark").select("item_id", "text").collect()]
    hits = brute.leaks([t for _, t, _ in before], items)
    assert after == [r for r, (_, hit, _) in zip(before, hits) if not hit]


def test_the_mix_comes_near_its_targets(stages):
    before, after = map(_rows, stages[3])
    assert set(after) <= set(before) and max(Counter(after).values()) <= 3
    sizes, got = Counter(), Counter()
    longest = Counter()
    for r in before:
        n = len(brute.spaced(r[1]))
        sizes[r[2]] += n
        longest[r[2]] = max(longest[r[2]], n)
    for r in after:
        got[r[2]] += len(brute.spaced(r[1]))
    names = sorted(sizes)
    for name, want in zip(names, _targets([sizes[n] for n in names])):
        assert abs(got[name] - want) <= 2 * longest[name] + 64


def test_every_copy_has_a_shard(stages):
    before, after = stages[4]
    rows = after.collect()
    assert Counter(r.doc_id for r in rows) == Counter(r.doc_id for r in before.collect())
    assert {r.shard for r in rows} <= set(range(16)) and all(0 <= r.grown_shard <= 16 for r in rows)


def test_an_empty_corpus(spark):
    docs = brute.frame(spark, [])
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF_SMALL)
        assert docs.count() == 0
