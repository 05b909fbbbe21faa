"""The layer jobs, run the way a scheduler would run them."""

from __future__ import annotations

import os

from strata import jobs
from strata.config import LayerConfig
from strata.plans import medallion

from . import roads_feed
from .test_layers_e2e import FILE1, HEADER


def test_jobs_end_to_end(spark, capsys):
    cfg = LayerConfig.scratch(spark, "jobs")
    base = ["--root", cfg.root, "--database", cfg.database]
    roads_feed.land(cfg.landing("raw_roads"))
    os.makedirs(cfg.landing("raw_traffic"))
    with open(os.path.join(cfg.landing("raw_traffic"), "raw_traffic1.csv"), "w") as fh:
        fh.write(HEADER + "\n" + "\n".join(FILE1) + "\n")

    assert jobs.main([*base, "setup"], spark=spark) == 0
    assert jobs.main([*base, "bronze"], spark=spark) == 0
    assert jobs.main([*base, "silver"], spark=spark) == 0
    # a later job in a fresh session: the catalog lost the tables, the data stays
    for t in (medallion.SILVER_TRAFFIC, medallion.SILVER_ROADS):
        spark.sql(f"DROP TABLE {cfg.table(t)}")
    assert jobs.main([*base, "gold"], spark=spark) == 0

    counts = {r.layer: r.n_rows for r in medallion.monitor_tables(spark, cfg).collect()}
    assert counts == {
        "raw_traffic": 6,
        "raw_roads": 145,
        "silver_traffic": 6,
        "silver_roads": 120,
        "gold_traffic": 6,
        "gold_roads": 120,
        "gold_traffic_roads": 6,
        "gold_region_summary": 2,  # (1, 3) and (1, 0): a NULL cell became 0
        "data_quality_quarantine": 14,
    }
    assert jobs.main([*base, "monitor"], spark=spark) == 0
    assert "silver_roads" in capsys.readouterr().out

    # roads rows still break their rules: nothing is re-inserted or purged
    rule = "[Road_ID] expect_column_values_to_not_be_null"
    assert jobs.main([*base, "recover", "--table", "raw_roads", "--rule", rule, "--purge"], spark=spark) == 0
    counts = {r.layer: r.n_rows for r in medallion.monitor_tables(spark, cfg).collect()}
    assert counts["raw_roads"] == 145 and counts["data_quality_quarantine"] == 14


def test_recover_with_corrected_suite(spark, tmp_path):
    import json

    from strata.operators.rules import suite_to_spec
    from strata.plans import roads

    cfg = LayerConfig.scratch(spark, "jobs-recover")
    base = ["--root", cfg.root, "--database", cfg.database]
    roads_feed.land(cfg.landing("raw_roads"), "raw_roads4.csv")
    assert jobs.main([*base, "bronze"], spark=spark) == 0
    before = {r.layer: r.n_rows for r in medallion.monitor_tables(spark, cfg).collect()}
    assert before["raw_roads"] == 25 and before["data_quality_quarantine"] == 3
    # the corrected suite no longer requires Road_ID
    spec = [e for e in suite_to_spec(roads.SUITE) if e["type"] != "expect_column_values_to_not_be_null"]
    spec_file = tmp_path / "roads_suite.json"
    spec_file.write_text(json.dumps(spec))
    rule = "[Road_ID] expect_column_values_to_not_be_null"
    args = [*base, "recover", "--table", "raw_roads", "--rule", rule, "--suite-spec", str(spec_file), "--purge"]
    assert jobs.main(args, spark=spark) == 0
    after = {r.layer: r.n_rows for r in medallion.monitor_tables(spark, cfg).collect()}
    assert after["raw_roads"] == 27 and after["data_quality_quarantine"] == 1


def test_monitor_before_anything_landed(spark, capsys):
    cfg = LayerConfig.scratch(spark, "jobs-empty")
    base = ["--root", cfg.root, "--database", cfg.database]
    for command in (["monitor"], ["silver"], ["gold"], ["recover", "--table", "raw_traffic", "--purge"]):
        assert jobs.main([*base, *command], spark=spark) == 0
    assert medallion.monitor_tables(spark, cfg).count() == 0


def test_one_feed_landed_only(spark):
    cfg = LayerConfig.scratch(spark, "one-feed")
    os.makedirs(cfg.landing("raw_traffic"))
    with open(os.path.join(cfg.landing("raw_traffic"), "raw_traffic1.csv"), "w") as fh:
        fh.write(HEADER + "\n" + "\n".join(FILE1) + "\n")
    assert jobs.main(["--root", cfg.root, "--database", cfg.database, "all"], spark=spark) == 0
    counts = {r.layer: r.n_rows for r in medallion.monitor_tables(spark, cfg).collect()}
    assert counts == {
        "raw_traffic": 6,
        "silver_traffic": 6,
        "gold_traffic": 6,
        "gold_region_summary": 2,
        "data_quality_quarantine": 11,
    }
    # the roads arrive later: the next run picks them up, traffic adds nothing
    roads_feed.land(cfg.landing("raw_roads"), "raw_roads1.csv")
    assert jobs.main(["--root", cfg.root, "--database", cfg.database, "all"], spark=spark) == 0
    counts = {r.layer: r.n_rows for r in medallion.monitor_tables(spark, cfg).collect()}
    assert counts["raw_traffic"] == 6 and counts["raw_roads"] == 40 and counts["gold_roads"] == 40
    assert counts["gold_traffic_roads"] == 6


def test_repair_from_the_command_line(spark):
    cfg = LayerConfig.scratch(spark, "jobs-repair")
    base = ["--root", cfg.root, "--database", cfg.database]
    os.makedirs(cfg.landing("raw_traffic"))
    with open(os.path.join(cfg.landing("raw_traffic"), "raw_traffic1.csv"), "w") as fh:
        fh.write(HEADER + "\n" + "\n".join(FILE1) + "\n")
    assert jobs.main([*base, "bronze"], spark=spark) == 0
    fix = "Count_date=date_format(try_to_timestamp(Count_date, 'dd/MM/yyyy HH:mm'), 'M/d/yyyy H:mm')"
    rule = "[Count_date] expect_column_values_to_match_strftime_format"
    assert jobs.main([*base, "recover", "--table", "raw_traffic", "--rule", rule, "--repair", fix, "--purge"], spark=spark) == 0
    bronze = spark.read.parquet(cfg.bronze("raw_traffic"))
    # 25/06 parses day first; 2/30 is no date either way: set to NULL, which passes
    assert {r.Count_point_id: r.Count_date for r in bronze.where("Count_point_id in (3, 4)").collect()} == {3: "6/25/2014 7:00", 4: None}
    counts = {r.layer: r.n_rows for r in medallion.monitor_tables(spark, cfg).collect()}
    assert (counts["raw_traffic"], counts["data_quality_quarantine"]) == (8, 9)


def test_the_monitor_reports_every_batch(spark, capsys):
    from strata.operators.quarantine import validate_and_write
    from strata.plans import traffic
    from strata.sources.files import with_extract_time
    from strata.sources.testdata import traffic_like

    from .conftest import SF_SMALL

    cfg = LayerConfig.scratch(spark, "jobs-batches")
    feed = with_extract_time(traffic_like(spark, SF_SMALL).limit(3)).persist()
    for i in range(30):
        validate_and_write(feed, i, suite=traffic.SUITE, target_path=cfg.bronze(traffic.TABLE), quarantine_path=cfg.quarantine())
    assert jobs.main(["--root", cfg.root, "--database", cfg.database, "monitor"], spark=spark) == 0
    report = spark.read.parquet(cfg.report("batch_quality"))
    assert report.count() == 30 and report.where("n_input <> 3").count() == 0
    assert "30" in capsys.readouterr().out


def test_a_broken_layer_fails_the_job(spark):
    import pytest

    cfg = LayerConfig.scratch(spark, "jobs-broken")
    base = ["--root", cfg.root, "--database", cfg.database]
    roads_feed.land(cfg.landing("raw_roads"), "raw_roads1.csv")
    assert jobs.main([*base, "all"], spark=spark) == 0
    folder = cfg.gold(medallion.GOLD_ROADS)
    for name in os.listdir(folder):
        if name.endswith(".parquet"):
            with open(os.path.join(folder, name), "r+b") as fh:
                fh.seek(-8, os.SEEK_END)
                fh.write(b"\0" * 8)
            os.remove(os.path.join(folder, f".{name}.crc"))
    spark.sql(f"DROP TABLE {cfg.table(medallion.GOLD_ROADS)}")
    with pytest.raises(Exception):
        jobs.main([*base, "monitor"], spark=spark)
