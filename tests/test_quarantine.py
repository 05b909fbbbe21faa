"""Batch validate-and-write: idempotent retries, table-level failures,
empty batches, fail-open, recovery and purge."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from strata.operators.quarantine import purge_quarantine, recover_quarantine, validate_and_write
from strata.operators.rules import STRFTIME, NotNull, Suite
from strata.plans import traffic
from strata.schemas import TRAFFIC_BRONZE_SCHEMA
from strata.sinks.tables import read_layer
from strata.sources.files import with_extract_time
from strata.sources.testdata import traffic_like

from .conftest import SF_SMALL


@pytest.fixture()
def bronze(spark):
    return with_extract_time(traffic_like(spark, SF_SMALL))


def _write(bronze, cfg, batch=0, suite=traffic.SUITE, **kw):
    return validate_and_write(
        bronze, batch, suite=suite, target_path=cfg.bronze("t"), quarantine_path=cfg.quarantine(), **kw
    )


def test_conservation_and_retry_is_idempotent(spark, cfg, bronze):
    n = bronze.count()
    _write(bronze, cfg)
    good, bad = read_layer(spark, cfg.bronze("t")).count(), read_layer(spark, cfg.quarantine()).count()
    assert good + bad == n and bad > 0
    _write(bronze, cfg)  # the same batch again, e.g. after a crash between writes
    assert read_layer(spark, cfg.bronze("t")).count() == good
    assert read_layer(spark, cfg.quarantine()).count() == bad
    _write(bronze, cfg, batch=1)  # a new batch appends
    assert read_layer(spark, cfg.bronze("t")).count() == 2 * good


def test_table_rule_wins_over_row_rules(spark, cfg, bronze):
    out = _write(bronze.withColumn("Extra", F.lit(1)), cfg)
    assert out.table_level
    q = read_layer(spark, cfg.quarantine())
    assert q.count() == bronze.count()
    assert {r.violated_rules for r in q.select("violated_rules").distinct().collect()} == {
        "Table-level Schema/Count Error"
    }
    assert not os.path.exists(cfg.bronze("t"))


def test_empty_batch_is_skipped(spark, cfg, bronze):
    out = _write(bronze.filter(F.lit(False)), cfg)
    assert out.skipped
    assert not os.path.exists(cfg.bronze("t")) and not os.path.exists(cfg.quarantine())


def test_fail_open_and_raise(spark, cfg, bronze):
    broken = Suite("t", (NotNull("Missing"),))
    with pytest.raises(Exception):
        _write(bronze, cfg, suite=broken)
    out = _write(bronze, cfg, suite=broken, on_error="pass_through")
    assert out.passed_through
    assert read_layer(spark, cfg.bronze("t")).count() == bronze.count()


def _repair(df):
    fixed = F.date_format(F.try_to_timestamp(F.col("Count_date"), F.lit("dd/MM/yyyy HH:mm")), "M/d/yyyy H:mm")
    return df.withColumn("Count_date", F.coalesce(fixed, F.col("Count_date")))


def test_recover_and_purge(spark, cfg, bronze):
    _write(bronze, cfg)
    q_before = read_layer(spark, cfg.quarantine())
    n_q = q_before.count()
    rule = f"[Count_date] {STRFTIME}"
    n_fmt = q_before.filter(F.array_contains(F.split("violated_rules", "; "), rule)).count()
    keys = recover_quarantine(
        spark,
        quarantine_path=cfg.quarantine(),
        table_name=traffic.TABLE,
        rule=rule,
        schema=TRAFFIC_BRONZE_SCHEMA,
        suite=traffic.SUITE,
        target_path=cfg.bronze("t"),
        repair=_repair,
    )
    n_rec = keys.count()
    assert 0 < n_rec <= n_fmt
    target = read_layer(spark, cfg.bronze("t"))
    assert target.filter(F.col("_batch_id").startswith("recovery-")).count() == n_rec
    purge_quarantine(spark, cfg.quarantine(), keys)
    after = read_layer(spark, cfg.quarantine())
    assert after.count() == n_q - n_rec
    # rows that broke another rule as well stay quarantined
    assert after.filter(F.array_contains(F.split("violated_rules", "; "), rule)).count() == n_fmt - n_rec


def test_purge_removes_emptied_partition(spark, cfg):
    df = spark.createDataFrame([(None, "x")], "Record_ID int, v string")
    suite = Suite("t", (NotNull("Record_ID"),))
    _write(df, cfg, suite=suite)
    q = read_layer(spark, cfg.quarantine())
    keys = q.select("table_name", "gx_batch_id", "raw_data")
    keys_path = cfg.root + "/keys"
    keys.write.parquet(keys_path)
    purge_quarantine(spark, cfg.quarantine(), spark.read.parquet(keys_path))
    assert spark.read.schema(q.schema).parquet(cfg.quarantine()).count() == 0


def test_corrupt_record_capture(spark, cfg):
    import os

    from strata.schemas import ROADS_SCHEMA
    from strata.sources.files import read_csv

    folder = cfg.landing("raw_roads")
    os.makedirs(folder)
    with open(os.path.join(folder, "raw_roads9.csv"), "w") as fh:
        fh.write("Road ID,Road category id,Road category,Region id,Region name,Total link length km,"
                 "Total link length miles,All motor vehicles\n")
        fh.write("1,1,TM,1,South West,301.339,187.24,3.465840186E9\n")
        fh.write("2,abc,TA,1,South West,993.586,617.39,3.48471021E9\n")
        fh.write("3,4,PA\n")
    rows = read_csv(spark, folder, ROADS_SCHEMA, glob="*.csv", corrupt_column="_corrupt_record").collect()
    by_id = {r.Road_ID: r for r in rows}
    assert by_id[1]._corrupt_record is None
    assert by_id[2].Road_Category_Id is None and by_id[2]._corrupt_record.startswith("2,abc")
    assert by_id[3].Region_ID is None and by_id[3]._corrupt_record == "3,4,PA"
    # without the column, malformed cells just become NULL
    plain = {r.Road_ID: r for r in read_csv(spark, folder, ROADS_SCHEMA, glob="*.csv").collect()}
    assert plain[2].Road_Category_Id is None and plain[3].Total_Link_Length_Km is None


def test_purge_through_catalog_table(spark, cfg):
    from strata.plans import medallion

    medallion.setup_tables(spark, cfg)
    table = cfg.table(cfg.quarantine_table)
    df = spark.createDataFrame([(None, "x"), (None, "y")], "Record_ID int, v string")
    suite = Suite("t", (NotNull("Record_ID"),))
    _write(df, cfg, batch=0, suite=suite)
    _write(df.limit(1), cfg, batch=1, suite=suite)
    medallion.refresh_partitions(spark, table)
    q = spark.table(table)
    assert q.count() == 3
    # purge everything of batch 0 and nothing of batch 1
    keys_path = cfg.root + "/keys"
    q.filter(F.col("gx_batch_id") == "0").select("table_name", "gx_batch_id", "raw_data").write.parquet(keys_path)
    purge_quarantine(spark, cfg.quarantine(), spark.read.parquet(keys_path), quarantine_table=table)
    left = read_layer(spark, cfg.quarantine())
    assert [(r.gx_batch_id, r.raw_data) for r in left.collect()] == [("1", '{"v":"x"}')]


def test_crash_between_writes_then_retry(spark, cfg, bronze, monkeypatch):
    import strata.operators.quarantine as qmod

    real = qmod.write_batch
    calls = {"n": 0}

    def failing_once(*args, **kwargs):
        calls["n"] += 1
        if calls["n"] == 1:
            raise RuntimeError("executor lost")
        return real(*args, **kwargs)

    monkeypatch.setattr(qmod, "write_batch", failing_once)
    with pytest.raises(RuntimeError):
        _write(bronze, cfg)  # quarantine written, good rows not
    assert read_layer(spark, cfg.quarantine()).count() > 0
    assert not os.path.exists(cfg.bronze("t"))
    _write(bronze, cfg)  # the retry of the same batch
    good, bad = read_layer(spark, cfg.bronze("t")).count(), read_layer(spark, cfg.quarantine()).count()
    assert good + bad == bronze.count()


def test_purge_is_safe_to_repeat(spark, cfg, bronze):
    _write(bronze, cfg)
    q = read_layer(spark, cfg.quarantine())
    n = q.count()
    # purge the rows that broke the hour rule only
    rule = "[hour] expect_column_values_to_be_between"
    keys_path = cfg.root + "/keys"
    q.filter(F.col("violated_rules") == rule).select("table_name", "gx_batch_id", "raw_data").write.parquet(keys_path)
    keys = spark.read.parquet(keys_path)
    n_keys = keys.count()
    purge_quarantine(spark, cfg.quarantine(), keys)
    once = read_layer(spark, cfg.quarantine()).count()
    purge_quarantine(spark, cfg.quarantine(), keys)  # a retried purge
    assert once == n - n_keys == read_layer(spark, cfg.quarantine()).count()


def _recover(spark, cfg, rule, suite=traffic.SUITE, **kw):
    return recover_quarantine(
        spark, quarantine_path=cfg.quarantine(), table_name=traffic.TABLE, rule=rule, schema=TRAFFIC_BRONZE_SCHEMA,
        suite=suite, target_path=cfg.bronze("t"), **kw
    )


def test_recoveries_do_not_replace_each_other_and_retries_do(spark, cfg, bronze):
    _write(bronze, cfg)
    n = bronze.count()
    rule = f"[Count_date] {STRFTIME}"
    before = read_layer(spark, cfg.bronze("t")).count()
    first = _recover(spark, cfg, rule, repair=_repair)
    again = _recover(spark, cfg, rule, repair=_repair)  # a retry before the purge
    assert first.count() == again.count()
    assert read_layer(spark, cfg.bronze("t")).count() == before + first.count()
    purge_quarantine(spark, cfg.quarantine(), first)
    loose = Suite(traffic.TABLE, tuple(r for r in traffic.SUITE.rules if r.column != "Record_ID"))
    purge_quarantine(spark, cfg.quarantine(), _recover(spark, cfg, "[Record_ID] expect_column_values_to_not_be_null", loose))
    assert read_layer(spark, cfg.bronze("t")).count() + read_layer(spark, cfg.quarantine()).count() == n
    with pytest.raises(ValueError, match="exists already"):
        _recover(spark, cfg, "[hour] expect_column_values_to_be_between", Suite(traffic.TABLE, ()), batch_id="0")


def test_recovered_rows_get_a_new_ingest_time(spark, cfg, bronze):
    old = F.lit("2020-01-01").cast("timestamp")
    _write(bronze.withColumn("Extract_Time", old), cfg)
    _recover(spark, cfg, f"[Count_date] {STRFTIME}", repair=_repair)
    rows = read_layer(spark, cfg.bronze("t")).where("_batch_id <> '0'")
    assert rows.count() > 0 and rows.where(F.col("Extract_Time") <= old).count() == 0


def test_retry_under_a_corrected_suite_is_exact(spark, cfg):
    df = spark.createDataFrame([(None, "x"), (None, "y")], "Record_ID int, v string")
    strict, loose = Suite("t", (NotNull("Record_ID"),)), Suite("t", (NotNull("v"),))
    _write(df, cfg, suite=strict)
    _write(df, cfg, suite=loose)  # now all rows are good
    assert read_layer(spark, cfg.bronze("t")).count() == 2
    assert not os.path.exists(os.path.join(cfg.quarantine(), "table_name=t", "gx_batch_id=0"))
    _write(df, cfg, suite=strict)  # and back
    assert read_layer(spark, cfg.quarantine()).count() == 2
    assert not os.path.exists(os.path.join(cfg.bronze("t"), "_batch_id=0"))


def test_labels_with_special_characters_and_leading_zeros(spark, cfg):
    df = spark.createDataFrame([(None, "x"), (1, "y")], "Record_ID int, v string")
    suite = Suite("t", (NotNull("Record_ID"),))
    for label in ("run:1/a=b", "007"):
        _write(df, cfg, batch=label, suite=suite)
    q = read_layer(spark, cfg.quarantine())
    assert sorted(r.gx_batch_id for r in q.collect()) == ["007", "run:1/a=b"]
    keys_path = cfg.root + "/keys"
    q.where("gx_batch_id = 'run:1/a=b'").select("table_name", "gx_batch_id", "raw_data").write.parquet(keys_path)
    purge_quarantine(spark, cfg.quarantine(), spark.read.parquet(keys_path))
    assert [r.gx_batch_id for r in read_layer(spark, cfg.quarantine()).collect()] == ["007"]


def test_fail_open_on_errors_while_rules_run(spark, cfg):
    from dataclasses import dataclass

    from strata.operators.rules import RowRule

    @dataclass(frozen=True)
    class Broken(RowRule):
        def failed(self):
            return (F.lit(1) / (F.col(self.column) - F.col(self.column))) > 0

    df = spark.createDataFrame([(1, "x"), (2, "y")], "Record_ID int, v string")
    suite = Suite("t", (Broken("Record_ID"),))
    with pytest.raises(Exception):
        _write(df, cfg, suite=suite)
    assert _write(df, cfg, suite=suite, on_error="pass_through").passed_through
    assert read_layer(spark, cfg.bronze("t")).count() == 2


def test_layer_exists_only_tells_of_data_files(spark, cfg):
    from strata.sinks.tables import layer_exists

    path = cfg.bronze("x")
    assert not layer_exists(spark, path)
    os.makedirs(path + "/_temporary/0")
    for name in ("_SUCCESS", "_temporary/0/part-0.parquet"):
        open(os.path.join(path, name), "w").close()
    assert not layer_exists(spark, path)
    os.makedirs(path + "/_batch_id=1")
    with open(path + "/_batch_id=1/part-0.parquet", "w") as fh:
        fh.write("not a parquet file")
    assert layer_exists(spark, path)
    with pytest.raises(Exception):
        read_layer(spark, path).count()


def test_quarantine_columns_are_commented(spark, cfg):
    from strata.plans import medallion

    medallion.setup_tables(spark, cfg)
    rows = spark.sql(f"DESCRIBE {cfg.table(cfg.quarantine_table)}").collect()
    assert all(r.comment for r in rows if r.col_name in ("table_name", "gx_batch_id", "violated_rules", "raw_data", "ingestion_time"))
