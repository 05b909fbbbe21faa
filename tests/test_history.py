"""Records delivered by several batches; recoveries in roots of batch loads."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from strata.config import LayerConfig
from strata.operators.clean import dedup_full_row, payload_digest
from strata.operators.quality import annotate, split
from strata.operators.rules import STRFTIME
from strata.plans import medallion, traffic
from strata.queries.spark_side import _repair_day_first
from strata.schemas import BATCH_COLUMN
from strata.sinks.history import KEY, DeliveryIndex
from strata.sinks.tables import create_file, read_layer
from strata.sources.files import with_extract_time
from strata.sources.testdata import roads_like, traffic_dup, traffic_like

from .conftest import SF_SMALL


@pytest.fixture(scope="module")
def feed(spark):
    good, _ = split(annotate(with_extract_time(traffic_dup(spark, SF_SMALL)), traffic.SUITE))
    return good.drop("Extract_Time").persist()


@pytest.fixture(scope="module")
def no_roads(spark):
    return roads_like(spark, SF_SMALL).limit(0)


def _ids(df):
    return sorted(r[0] for r in df.select("Count_point_id").collect())


def _state(spark, cfg, run):
    """Silver's and gold's ids, and the distinct ids of bronze."""
    bronze = dedup_full_row(run.bronze(spark, traffic.TABLE))
    return _ids(run.silver(spark, medallion.SILVER_TRAFFIC)), _ids(run.gold(spark, medallion.GOLD_TRAFFIC)), _ids(bronze)


def test_a_corrected_retry_loses_no_other_batchs_records(spark, feed, no_roads):
    cfg = LayerConfig.scratch(spark, "retry")
    ids = sorted({r[0] for r in feed.select("Count_point_id").collect()})[:30]
    part = lambda lo, hi: feed.where(F.col("Count_point_id").isin(ids[lo:hi]))
    load = lambda batch, lo, hi: medallion.run_batch(spark, cfg, part(lo, hi), no_roads, batch)
    load("a", 0, 20)
    load("b", 10, 30)
    run = load("a", 0, 10)  # 10-19 are b's now
    assert _state(spark, cfg, run) == (ids, ids, ids)
    load("c", 5, 15)
    run = load("b", 20, 30)  # 10-14 go to c, 15-19 go: nobody delivers them
    left = ids[:15] + ids[20:]
    assert _state(spark, cfg, run) == (left, left, left)
    run = load("a", 29, 30)  # 5-9 stay, with c; its one record is b's
    left = ids[5:15] + ids[20:]
    assert _state(spark, cfg, run) == (left, left, left)
    run = load("a", 0, 30)
    assert _state(spark, cfg, run) == (ids, ids, ids)


def test_a_load_that_failed_midway_is_made_good_by_its_retry(spark, feed, no_roads, monkeypatch):
    cfg = LayerConfig.scratch(spark, "midway")
    load = lambda batch, rows: medallion.run_batch(spark, cfg, rows, no_roads, batch)
    load("a", feed)
    load("b", feed.where("Region_id < 3"))
    real, calls = medallion.write_owned, []

    def failing(*args):
        if args[3] is traffic:
            calls.append(args[-1])
        raise OSError("lost")

    monkeypatch.setattr(medallion, "write_owned", failing)
    with pytest.raises(OSError, match="lost"):
        load("a", feed.where("Region_id >= 3"))  # b's index says that it owns the rest; its layers do not
    assert calls == ["load-b"]
    monkeypatch.setattr(medallion, "write_owned", real)
    run = load("a", feed.where("Region_id >= 3"))
    silver, gold, bronze = _state(spark, cfg, run)
    assert silver == gold == bronze and len(silver) == len(set(silver))


def test_the_history_is_not_shuffled(spark, feed, no_roads):
    cfg = LayerConfig.scratch(spark, "buckets")
    medallion.run_batch(spark, cfg, feed.where("Region_id < 3"), no_roads, "a")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        index = DeliveryIndex.open(spark, cfg.table("silver_traffic_keys"), cfg.silver_keys("silver_traffic"))
        keys = feed.select(payload_digest(feed).alias(KEY)).distinct()
        flagged = index.flagged(keys, "load-b")
        plan = flagged._jdf.queryExecution().executedPlan().toString()
        heirs = index.heirs(keys, "load-a")._jdf.queryExecution().executedPlan().toString()
        assert flagged.count() == keys.count() and 0 < flagged.where("owner").count() < keys.count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    for text in (plan, heirs):
        scans = [i for i, line in enumerate(text.split("\n")) if "FileScan" in line and "silver_keys" in line]
        for i in scans:
            lines = text.split("\n")
            depth = lambda x: len(x) - len(x.lstrip(" :+-*()0123456789"))
            above, at = [], depth(lines[i])
            for line in reversed(lines[:i]):
                if depth(line) < at:
                    above.append(line)
                    at = depth(line)
            first = next(x for x in above if "Exchange" in x or "Join" in x)
            assert "Join" in first, text
        assert scans and "SelectedBucketsCount" in text or "Bucketed: true" in text


def test_a_second_load_at_the_same_time_raises(spark, feed, no_roads):
    cfg = LayerConfig.scratch(spark, "claims")
    medallion.run_batch(spark, cfg, feed, no_roads, "a")
    claim = f"{cfg.silver_keys('silver_traffic')}.claim"
    assert create_file(spark, claim, "load-b") and not create_file(spark, claim, "load-c")
    with pytest.raises(RuntimeError, match="load-b"):
        medallion.run_batch(spark, cfg, feed, no_roads, "c")
    run = medallion.run_batch(spark, cfg, feed, no_roads, "b")  # its own claim, of an attempt that was lost
    assert create_file(spark, claim, "free again")
    assert run.silver(spark, medallion.SILVER_TRAFFIC).count() == dedup_full_row(feed).count()


def test_another_session_finds_the_index(spark, feed, no_roads):
    cfg = LayerConfig.scratch(spark, "lost-catalog")
    medallion.run_batch(spark, cfg, feed.where("Region_id < 3"), no_roads, "a")
    spark.sql(f"DROP TABLE {cfg.table('silver_traffic_keys')}")
    run = medallion.run_batch(spark, cfg, feed, no_roads, "b")
    assert run.silver(spark, medallion.SILVER_TRAFFIC).count() == dedup_full_row(feed).count()


def _recover(spark, cfg, **how):
    rule = f"[Count_date] {STRFTIME}"
    return medallion.recover_layers(spark, cfg, traffic.TABLE, rule, traffic.SUITE, repair=_repair_day_first, **how)


def test_recovered_rows_reach_gold_and_come_back_once(spark, no_roads):
    cfg = LayerConfig.scratch(spark, "recover-batches")
    landing = traffic_like(spark, SF_SMALL)
    run = medallion.run_batch(spark, cfg, landing.where("Region_id < 2"), no_roads, "1")
    good = run.bronze(spark, traffic.TABLE).count()
    first = _recover(spark, cfg)
    n = first.keys.count()
    assert n > 0 and len(first.labels) == 1
    again = _recover(spark, cfg)  # nothing was purged
    assert again.labels == first.labels and again.keys.count() == n
    assert run.bronze(spark, traffic.TABLE).count() == good + n == run.gold(spark, medallion.GOLD_TRAFFIC).count()
    medallion.run_batch(spark, cfg, landing.where("Region_id >= 2"), no_roads, "2")
    both = _recover(spark, cfg, purge=True)
    assert len(both.labels) == 2 and both.keys.count() > n
    bronze, gold = run.bronze(spark, traffic.TABLE), run.gold(spark, medallion.GOLD_TRAFFIC)
    assert bronze.count() == gold.count() == bronze.select("Count_point_id").distinct().count()
    assert bronze.count() + run.quarantine(spark).count() == landing.count()
    assert _recover(spark, cfg).keys.isEmpty()


def test_a_recovery_that_was_lost_before_its_write_is_made_again(spark, no_roads):
    from strata.sinks.tables import drop_partition

    cfg = LayerConfig.scratch(spark, "recover-lost")
    run = medallion.run_batch(spark, cfg, traffic_like(spark, SF_SMALL), no_roads, "1")
    first = _recover(spark, cfg)
    rows = run.bronze(spark, traffic.TABLE).count()
    drop_partition(spark, cfg.bronze(traffic.TABLE), {BATCH_COLUMN: first.labels[0]})  # logged, but never written
    second = _recover(spark, cfg)
    assert second.labels == first.labels and read_layer(spark, cfg.bronze(traffic.TABLE)).count() == rows
