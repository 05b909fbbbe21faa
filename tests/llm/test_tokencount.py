from __future__ import annotations

import os
import random

import pytest
from pyspark.sql import functions as F

from strata.llm.common import read_table
from strata.llm.tokencount import PATTERN, RANK_FILE, TokenTree, count_tokens, op7_token_counts, sample_edits, token_counter
from . import brute
from ..conftest import SF_SMALL

pytestmark = pytest.mark.skipif(not os.path.exists(RANK_FILE), reason="no rank file")
PARTS = ["a", "b", " ", "  ", "\n", "'", "s", "ll", "1", "23", "é", "!", "..", "\t", "ß", "日本", "the", "'re"]


def test_trees_equal_a_fresh_count_after_random_edits():
    count, split = token_counter(RANK_FILE, PATTERN)
    rnd = random.Random(1)
    some = lambda n: "".join(rnd.choice(PARTS) for _ in range(n))
    again = total = 0
    for k in range(1500):
        text = some(rnd.choice([0, 1, 3, 20, 200, 1500 if k % 25 == 0 else 60]))
        tree = TokenTree(text, count, split)
        for _ in range(rnd.randint(1, 4)):
            a = rnd.randint(0, len(text) + 2)
            b, new = a + rnd.choice([0, 0, 1, 3, 30]), some(rnd.choice([0, 1, 2, 10, 700 if k % 20 == 0 else 5]))
            text = text[:a] + new + text[b:]
            tree.replace(a, b, new)
            pieces = split.findall(text)
            assert [s for sizes, _ in tree.blocks for s in sizes] == [len(p) for p in pieces]
            assert (tree.tokens, tree.pre_tokens, tree.chars[1]) == (sum(map(count, pieces)), len(pieces), len(text))
            total += len(pieces)
        again += tree.encoded
    assert again < total


def test_an_edit_of_a_long_text_encodes_little_again():
    count, split = token_counter(RANK_FILE, PATTERN)
    text = "some words of a long text " * 20_000
    tree = TokenTree(text, count, split)
    tree.replace(250_000, 250_010, "changed here")
    assert tree.encoded < 12
    assert tree.tokens == sum(map(count, split.findall(tree.text)))


def _edited(text):
    n = len(text)
    for start, size, new in ((n * 3 // 4, min(9, n // 8), ""), (n // 2, 0, " with 2 new words"), (n // 4, min(12, n // 8), " edited text")):
        text = text[:start] + new + text[start + size :]
    return text


def _check(rows, got):
    count, split = token_counter(RANK_FILE, PATTERN)
    size = lambda t: (sum(map(count, split.findall(t))), len(split.findall(t)))
    want = sorted((d, *size(t or ""), *size(_edited(t or ""))) for d, t in rows)
    assert sorted(tuple(r)[:5] for r in got) == want


def test_all_documents_of_the_table(spark):
    rows = [(r.doc_id, r.text) for r in read_table(spark, SF_SMALL, "documents").select("doc_id", "text").collect()]
    got = op7_token_counts(spark, SF_SMALL).collect()
    _check(rows, got)
    assert sum(r.reencoded for r in got) < 0.2 * sum(r.n_pretokens for r in got)


def test_odd_texts_and_no_edits(spark):
    rows = [(1, None), (2, ""), (3, "a"), (3, "a"), (4, "日本" * 40), (5, "word " * 30_000), (6, " " * 500)]
    docs = brute.frame(spark, [(*r, None, None) for r in rows], clash=True)
    _check(rows, count_tokens(docs, sample_edits(F.col("text"))).collect())
    none = F.lit(None).cast("array<struct<start:int,end:int,new:string>>")
    assert all(r.n_tokens == r.edited_tokens and r.reencoded == 0 for r in count_tokens(docs, none).collect())
    assert count_tokens(docs.limit(0), none).count() == 0
