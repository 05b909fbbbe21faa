"""Batch layer runs over several batches; watermark-bounded stream dedup."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from strata.config import LayerConfig, fresh_dir
from strata.operators.clean import dedup_full_row
from strata.operators.quality import annotate, split
from strata.plans import medallion, traffic
from strata.sources.files import with_extract_time
from strata.sources.testdata import roads_like, traffic_dup
from strata.streaming.chain import stream_dedup
from strata.streaming.ingest import run_available_now

from .conftest import SF_SMALL


def test_two_batches_keep_silver_distinct(spark):
    cfg = LayerConfig.scratch(spark, "two-batches")
    feed = traffic_dup(spark, SF_SMALL)
    rds = roads_like(spark, SF_SMALL)
    # the second batch re-delivers every record of region 0
    b1 = feed.filter(F.col("Region_id") < 3)
    b2 = feed.filter((F.col("Region_id") >= 3) | (F.col("Region_id") == 0))
    medallion.run_batch(spark, cfg, b1, rds, "1")
    run = medallion.run_batch(spark, cfg, b2, rds.limit(0), "2")
    good, _ = split(annotate(with_extract_time(b1.unionByName(b2)), traffic.SUITE))
    expected = dedup_full_row(good).count()
    assert run.silver(spark, medallion.SILVER_TRAFFIC).count() == expected
    assert run.gold(spark, medallion.GOLD_TRAFFIC).count() == expected
    assert run.bronze(spark, "raw_traffic").count() == good.count()


def test_stream_dedup_within_watermark(spark):
    src, out, chk = (fresh_dir(spark, x) for x in ("wm-src", "wm-out", "wm-chk"))
    t0 = dt.datetime(2024, 1, 1, 12, 0)
    first = [(1, "a", t0), (2, "b", t0), (1, "a", t0 + dt.timedelta(minutes=5))]
    second = [(2, "b", t0 + dt.timedelta(minutes=10)), (3, "c", t0 + dt.timedelta(minutes=10))]
    schema = "k int, v string, ts timestamp"

    def run(rows):
        spark.createDataFrame(rows, schema).write.mode("append").parquet(src)
        stream = spark.readStream.schema(schema).parquet(src)
        q = (
            stream_dedup(stream, ["k", "v"], watermark_column="ts", watermark_delay="1 hour")
            .writeStream.format("parquet")
            .option("path", out)
            .option("checkpointLocation", chk)
            .trigger(availableNow=True)
            .start()
        )
        run_available_now(q)

    run(first)
    run(second)
    got = sorted((r.k, r.v) for r in spark.read.parquet(out).collect())
    assert got == [(1, "a"), (2, "b"), (3, "c")]


def test_stream_chain_with_bounded_dedup(spark):
    import os

    cfg = LayerConfig.scratch(spark, "horizon")
    feed = traffic_dup(spark, SF_SMALL)
    medallion.write_landing_csv(feed, cfg.landing("raw_traffic"))
    medallion.write_landing_csv(roads_like(spark, SF_SMALL), cfg.landing("raw_roads"))
    medallion.run_streams(
        spark, cfg, dedup_horizon="7 days", sources=medallion.landing_sources(cfg, per_feed_folders=True)
    )
    good, _ = split(annotate(with_extract_time(feed), traffic.SUITE))
    silver = spark.read.parquet(cfg.silver(medallion.SILVER_TRAFFIC))
    assert silver.count() == dedup_full_row(good).count()
    assert os.path.isdir(cfg.checkpoint("silver_traffic_load"))


def _layer_rows(spark, cfg):
    from strata.sinks.tables import read_layer

    return read_layer(spark, cfg.bronze("raw_traffic")).count(), read_layer(spark, cfg.quarantine()).count()


def test_a_stream_a_reset_checkpoint_and_a_load_keep_each_others_rows(spark):
    import shutil

    cfg = LayerConfig.scratch(spark, "labels")
    feed = traffic_dup(spark, SF_SMALL)
    sources = medallion.landing_sources(cfg, per_feed_folders=True)
    medallion.write_landing_csv(feed, cfg.landing("raw_traffic"))
    medallion.run_streams(spark, cfg, sources=sources)
    good, bad = _layer_rows(spark, cfg)
    assert good + bad == feed.count()
    one = feed.limit(40)
    medallion.run_batch(spark, LayerConfig(root=cfg.root, database="none"), one, roads_like(spark, SF_SMALL).limit(0), "0")
    after = _layer_rows(spark, cfg)
    assert sum(after) == feed.count() + 40
    shutil.rmtree(cfg.checkpoint("bronze_raw_traffic"))
    for q in medallion.start_bronze_streams(spark, cfg, sources=sources):
        run_available_now(q)
    assert _layer_rows(spark, cfg) == (after[0] + good, after[1] + bad)  # delivered twice, none replaced


def test_a_repeated_load_replaces_itself_in_every_layer(spark):
    cfg = LayerConfig.scratch(spark, "repeat-load")
    feed, rds = traffic_dup(spark, SF_SMALL), roads_like(spark, SF_SMALL)
    runs = [medallion.run_batch(spark, cfg, feed, rds, "a") for _ in range(2)]
    runs.append(medallion.run_batch(spark, cfg, feed, rds, "b"))  # all repeats: nothing new above bronze
    good, _ = split(annotate(with_extract_time(feed), traffic.SUITE))
    distinct = dedup_full_row(good).count()
    for run in runs:
        assert run.silver(spark, medallion.SILVER_TRAFFIC).count() == distinct
        assert run.gold(spark, medallion.GOLD_TRAFFIC).count() == distinct
    assert runs[0].bronze(spark, "raw_traffic").count() == 2 * good.count()
    first = runs[0].gold(spark, medallion.GOLD_TRAFFIC)
    assert first.columns[-2:] == ["Vehicle_Indensity", "Loading_Time"] and "_batch_id" not in first.columns
