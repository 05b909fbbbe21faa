from __future__ import annotations

import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from strata.llm.sharding import rendezvous, shard_records
from . import brute


def test_sizes_checksums_and_gapless_slots(spark):
    texts = [None, "", "é" * 50, "x" * 300_000, "same", "same"]
    rows = [(i, t, None, None) for i, t in enumerate(texts)] + [(None, "no id", None, None), (4, "same", None, None), (4, "other", None, None)]
    got = shard_records(brute.frame(spark, rows, clash=True), [1.0] * 4).collect()
    assert len(got) == len(rows)
    by_id = {r.doc_id: r for r in got}
    for i, t in enumerate(texts[:4]):
        data = (t or "").encode()
        assert (by_id[i].size, by_id[i].text_crc32) == (len(data) + 1, zlib.crc32(data))
    assert len({r.shard for r in got if r.doc_id == 4}) == 1
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_one_more_shard_takes_rows_only_into_itself(spark):
    ids = spark.range(4000)
    rows = ids.select(rendezvous(F.col("id"), [1.0] * 7).alias("a"), rendezvous(F.col("id"), [1.0] * 8).alias("b")).collect()
    moved = [r for r in rows if r.a != r.b]
    assert {r.b for r in moved} == {7}
    assert 350 < len(moved) < 650


def test_weights_decide_the_shares(spark):
    got = Counter(r.s for r in spark.range(6000).select(rendezvous(F.col("id"), [1.0, 2.0, 3.0]).alias("s")).collect())
    assert all(abs(got[s] - 1000 * (s + 1)) < 200 for s in range(3))


def test_empty_table_and_bad_weights(spark):
    assert shard_records(brute.frame(spark, []), [1.0]).count() == 0
    with pytest.raises(ValueError):
        rendezvous(F.col("id"), [1.0, 0.0])
