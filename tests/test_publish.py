"""Batches published through the catalog; streams that run together; observed counts."""

from __future__ import annotations

import time

import pytest
from pyspark.errors import PySparkException, StreamingQueryException
from pyspark.sql import functions as F

from strata.config import LayerConfig, fresh_dir
from strata.operators import monitor
from strata.operators.quarantine import validate_and_write
from strata.plans import gold as gold_plan
from strata.plans import medallion, traffic
from strata.schemas import BATCH_COLUMN
from strata.sinks.publish import publish, published, remove_unpublished, table_location
from strata.sinks.tables import create_database, create_table, list_folders, read_layer
from strata.sources.testdata import roads_like, traffic_dup, traffic_like
from strata.streaming.ingest import run_together, start_together

from .conftest import SF_SMALL


@pytest.fixture()
def tables(spark, cfg):
    create_database(spark, cfg.database, f"{cfg.root}/catalog")
    names = [cfg.table("first"), cfg.table("second")]
    schema = spark.createDataFrame([], f"k int, v string, {BATCH_COLUMN} string").schema
    for name in names:
        create_table(spark, name, schema, f"{cfg.root}/{name}", partitioned_by=[BATCH_COLUMN])
    return names


def _rows(spark, ks, fail=False):
    rows = spark.createDataFrame([(k, f"v{k}") for k in ks], "k int, v string")
    return rows.withColumn("v", F.when(F.col("k") >= 0, F.raise_error(F.lit("no"))).cast("string")) if fail else rows


def _seen(spark, names):
    return [sorted((r[BATCH_COLUMN], r.k) for r in spark.table(n).collect()) for n in names]


def test_a_batch_shows_in_all_tables_or_in_none(spark, tables):
    first, second = tables
    spec = lambda b: {BATCH_COLUMN: b}
    publish(spark, [(first, spec("it's 1"), _rows(spark, [1])), (second, spec("it's 1"), _rows(spark, [2]))])
    state = [[("it's 1", 1)], [("it's 1", 2)]]
    assert _seen(spark, tables) == state
    for batch in ("2", "it's 1"):  # a new batch and a replaced one
        with pytest.raises(PySparkException):
            publish(spark, [(first, spec(batch), _rows(spark, [3])), (second, spec(batch), _rows(spark, [4], fail=True))])
        assert _seen(spark, tables) == state
    publish(spark, [(first, spec("it's 1"), _rows(spark, [5, 6])), (second, spec("it's 1"), None)])
    assert _seen(spark, tables) == [[("it's 1", 5), ("it's 1", 6)], []]
    kept = published(spark, first)
    assert len(kept) == 1
    assert remove_unpublished(spark, first) == 3 and remove_unpublished(spark, second) == 3
    assert len(list_folders(spark, f"{table_location(spark, first)}/_versions")) == 1
    assert _seen(spark, tables) == [[("it's 1", 5), ("it's 1", 6)], []]


def test_a_published_batch_counts_what_it_wrote(spark):
    cfg = LayerConfig.scratch(spark, "published")
    medallion.setup_tables(spark, cfg)
    landing = traffic_like(spark, SF_SMALL)
    names = cfg.table(traffic.TABLE), cfg.table(cfg.quarantine_table)
    for _ in range(2):  # the retry replaces it
        outcome = validate_and_write(
            medallion.with_extract_time(landing), 0, suite=traffic.SUITE, target_path="unused", quarantine_path="unused", publish_to=names
        )
        assert (outcome.n_good, outcome.n_quarantined) == tuple(spark.table(n).count() for n in names)
        assert outcome.n_good + outcome.n_quarantined == landing.count()


def _stream(spark, checkpoint, handle):
    source = spark.readStream.format("rate-micro-batch").option("rowsPerBatch", 10).load()
    return source.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(processingTime="0 seconds")


def test_the_first_failure_stops_the_other_streams(spark):
    pools = []

    def fails(batch, n):
        raise ValueError("lost feed")

    def goes_on(batch, n):
        pools.append(batch.sparkSession.sparkContext.getLocalProperty("spark.scheduler.pool"))
        time.sleep(0.1)

    starts = {
        "good": lambda: _stream(spark, fresh_dir(spark, "good"), goes_on).start(),
        "bad": lambda: _stream(spark, fresh_dir(spark, "bad"), fails).start(),
    }
    queries = start_together(spark, starts)
    t0 = time.time()
    with pytest.raises(StreamingQueryException, match="lost feed"):
        run_together(queries)
    assert not any(q.isActive for q in queries) and time.time() - t0 < 60
    assert spark.sparkContext.getLocalProperty("spark.scheduler.pool") is None


def test_streams_stop_if_another_does_not_start(spark):
    started = []

    def good():
        started.append(_stream(spark, fresh_dir(spark, "good"), lambda batch, n: time.sleep(0.05)).start())
        return started[0]

    def bad():
        raise OSError("no source")

    with pytest.raises(OSError, match="no source"):
        start_together(spark, {"good": good, "bad": bad})
    assert started and not started[0].isActive


def test_observed_counts_equal_the_layers(spark):
    cfg = LayerConfig.scratch(spark, "counted")
    medallion.write_landing_csv(traffic_dup(spark, SF_SMALL), cfg.landing("raw_traffic"))
    medallion.write_landing_csv(roads_like(spark, SF_SMALL), cfg.landing("raw_roads"))
    sources = medallion.landing_sources(cfg, per_feed_folders=True)
    for _ in range(2):  # the second run finds nothing new
        medallion.run_streams(spark, cfg, sources=sources, count_rows=True)
        counts = monitor.recorded_counts(spark, cfg.report(medallion.LAYER_COUNTS))
        got = {r.layer: r.n_rows for r in counts.collect()}
        quarantine = read_layer(spark, cfg.quarantine())
        want = {t: read_layer(spark, cfg.bronze(t)).count() for t in ("raw_traffic", "raw_roads")}
        want |= {f"{t}_quarantine": quarantine.where(F.col("table_name") == t).count() for t in list(want)}
        want |= {t: spark.read.parquet(cfg.silver(t)).count() for t in (medallion.SILVER_TRAFFIC, medallion.SILVER_ROADS)}
        want |= {t: spark.read.parquet(cfg.gold(t)).count() for t in (medallion.GOLD_TRAFFIC, medallion.GOLD_ROADS)}
        assert got == want
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert "layer_counts" in plan and "bronze" not in plan and "silver" not in plan and "medallion" not in plan


def test_states_give_the_summary_and_follow_replaced_batches(spark, monkeypatch):
    cfg = LayerConfig.scratch(spark, "states")
    feed, no_roads = traffic_dup(spark, SF_SMALL), roads_like(spark, SF_SMALL).limit(0)
    rows = lambda df: sorted(map(tuple, df.collect()), key=str)

    def check(run):
        want = gold_plan.region_summary(run.gold(spark, medallion.GOLD_TRAFFIC))
        assert rows(run.gold(spark, medallion.GOLD_REGION_SUMMARY)) == rows(want)

    check(medallion.run_batch(spark, cfg, feed, no_roads, "a"))
    check(medallion.run_batch(spark, cfg, feed.where("Region_id = 1"), no_roads, "b"))
    read = []
    real = gold_plan.region_states
    monkeypatch.setattr(gold_plan, "region_states", lambda df: read.append(df.count()) or real(df))
    check(medallion.run_batch(spark, cfg, feed.where("Region_id = 2"), no_roads, "c"))
    assert sum(read) == 0  # all repeats: no state is made, none is read again
    check(medallion.run_batch(spark, cfg, feed.where("Region_id > 2"), no_roads, "a"))
    check(medallion.run_batch(spark, cfg, feed.limit(0), no_roads, "b"))
    # A root whose states were lost or never kept.
    from strata.sinks.tables import delete_path

    delete_path(spark, cfg.gold(medallion.GOLD_REGION_STATES))
    check(medallion.run_batch(spark, cfg, feed.limit(0), no_roads, "d"))


def test_tombstones_hide_rows_until_compaction_removes_them(spark):
    from strata.operators import quarantine as q
    from strata.operators.rules import STRFTIME

    cfg = LayerConfig.scratch(spark, "tombstones")
    landing = traffic_like(spark, SF_SMALL)
    validate_and_write(
        medallion.with_extract_time(landing), 0, suite=traffic.SUITE, target_path=cfg.bronze(traffic.TABLE), quarantine_path=cfg.quarantine()
    )
    path, rule = cfg.quarantine(), f"[Count_date] {STRFTIME}"
    rows = lambda df: sorted(r.raw_data for r in df.collect())
    before = rows(read_layer(spark, path))
    assert rows(q.live_quarantine(spark, path)) == before
    q.compact_quarantine(spark, path)  # nothing is marked
    keys = read_layer(spark, path).where(F.col("violated_rules") == rule).select(*q.QUARANTINE_KEY)
    gone = rows(keys)
    left = sorted(set(before) - set(gone))
    assert gone and len(before) == len(set(before))
    q.mark_purged(spark, path, keys.limit(0))
    for _ in range(2):  # marked again after a lost driver
        q.mark_purged(spark, path, keys)
        assert rows(q.live_quarantine(spark, path)) == left and rows(read_layer(spark, path)) == before
    q.compact_quarantine(spark, path)
    assert rows(q.live_quarantine(spark, path)) == left == rows(read_layer(spark, path))
    assert list_folders(spark, f"{path}_purged") == []


def test_read_files_move_to_the_archive(spark):
    import os

    from strata.schemas import TRAFFIC_SCHEMA
    from strata.sources.files import stream_csv
    from strata.streaming.ingest import run_available_now

    cfg = LayerConfig.scratch(spark, "archived")
    landing, archive, feed = cfg.landing("raw_traffic"), f"{cfg.root}/archive", traffic_like(spark, SF_SMALL)
    files = lambda path: sorted(f for _, _, names in os.walk(path) for f in names if f.endswith(".csv"))
    seen, all_files = [], set()
    for wave in ("Region_id < 2", "Region_id = 2", "Region_id > 2"):
        medallion.write_landing_csv(feed.where(wave).coalesce(2), landing)
        all_files |= set(files(landing))
        stream = stream_csv(spark, landing, TRAFFIC_SCHEMA, glob="*.csv", archive=archive, max_file_age="30d")
        query = stream.writeStream.format("parquet").option("path", f"{cfg.root}/out").option("checkpointLocation", cfg.checkpoint("a"))
        run_available_now(query.trigger(availableNow=True).start())
        seen.append(len(files(archive)))
    assert seen[-1] >= 2 and sorted(files(landing) + files(archive)) == sorted(all_files)
    assert spark.read.parquet(f"{cfg.root}/out").count() == feed.count()
