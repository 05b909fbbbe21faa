"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame.

Every query reads the benchmark tables in full (through the derived feeds
of ``strata.sources.testdata``) and runs one operator of the inventory on
them.  Queries that exercise sinks or streams write under a fresh folder
below the shared checkpoint root and return what they wrote, read back.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.errors import PySparkException, StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.config import LayerConfig, fresh_dir
from strata.functions.strftime import matches_strftime
from strata.operators import clean, monitor, quality
from strata.operators.quality import VIOLATIONS, annotate, split
from strata.operators.quarantine import (
    compact_quarantine,
    live_quarantine,
    mark_purged,
    purge_quarantine,
    recover_batch,
    recover_quarantine,
    validate_and_write,
)
from strata.operators.rules import BETWEEN, STRFTIME, MatchesStrftime, MaxLength, NotNull, Suite
from strata.plans import gold as gold_plan
from strata.plans import medallion, roads, traffic
from strata.schemas import (
    BATCH_COLUMN,
    EXTRACT_TIME,
    LOADING_TIME,
    ROADS_SCHEMA,
    TRAFFIC_BRONZE_SCHEMA,
    TRAFFIC_COLUMNS,
    TRAFFIC_SCHEMA,
    TRANSFORMED_TIME,
)
from strata.sinks.publish import publish
from strata.sinks.tables import read_layer, write_batch
from strata.sources.files import CORRUPT, header_report, read_csv, stream_csv, with_extract_time, with_source_file
from strata.sources.testdata import load, roads_like, traffic_dup, traffic_like
from strata.sources.tables import stream_table
from strata.streaming.chain import stream_dedup
from strata.streaming.ingest import run_available_now, run_together, start_together, start_validated_ingest

TRAFFIC_PAYLOAD = [name for name, _ in TRAFFIC_COLUMNS]


# ---------------------------------------------------------------- helpers


def _bronze_traffic(spark, sf_dir, dup: bool = False) -> DataFrame:
    src = traffic_dup(spark, sf_dir) if dup else traffic_like(spark, sf_dir)
    return with_extract_time(src)


def _good_traffic(spark, sf_dir, dup: bool = False) -> DataFrame:
    good, _ = split(annotate(_bronze_traffic(spark, sf_dir, dup), traffic.SUITE))
    return good


def _good_roads(spark, sf_dir) -> DataFrame:
    good, _ = split(annotate(roads_like(spark, sf_dir), roads.SUITE))
    return good


def _quarantine_view(q: DataFrame) -> DataFrame:
    """Comparable projection of quarantine rows: the row key from the JSON
    payload instead of the JSON text (number formatting differs between
    engines), and the audit time as a flag."""
    key = F.coalesce(F.get_json_object("raw_data", "$.Count_point_id"), F.get_json_object("raw_data", "$.Road_ID"))
    return q.select(
        "table_name",
        "gx_batch_id",
        "violated_rules",
        key.cast("int").alias("row_key"),
        F.col("ingestion_time").isNotNull().alias("has_ingestion_time"),
    )


def _validate_both(spark, sf_dir) -> LayerConfig:
    """Validate both feeds as batch 0 into their bronze tables and one
    quarantine (the two jobs run concurrently); return their configuration."""
    cfg = LayerConfig.scratch(spark, "quarantine")
    medallion.run_concurrently(
        lambda: validate_and_write(
            _bronze_traffic(spark, sf_dir), 0, suite=traffic.SUITE, target_path=cfg.bronze(traffic.TABLE),
            quarantine_path=cfg.quarantine(),
        ),
        lambda: validate_and_write(
            roads_like(spark, sf_dir), 0, suite=roads.SUITE, target_path=cfg.bronze(roads.TABLE),
            quarantine_path=cfg.quarantine(),
        ),
    )
    return cfg


def _quarantine_both(spark, sf_dir) -> str:
    return _validate_both(spark, sf_dir).quarantine()


# ------------------------------------------------------------ sources (S)


def csv_schema_on_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3: CSV read by position with an explicit schema; a non-numeric
    cell becomes NULL."""
    src = roads_like(spark, sf_dir)
    as_text = src.select(*[F.col(c).cast("string").alias(c) for c in src.columns]).withColumn(
        "Road_Category_Id",
        F.when(F.col("Road_ID") % 53 == 0, F.lit("abc")).otherwise(F.col("Road_Category_Id")),
    )
    path = fresh_dir(spark, "csv-landing")
    medallion.write_landing_csv(as_text, path)
    return read_csv(spark, path, ROADS_SCHEMA, glob="*.csv")


# ---------------------------------------------------------- rules (V1-V6)


def rule_not_null(spark, sf_dir):
    df = traffic_like(spark, sf_dir)
    return df.select("Count_point_id", "Record_ID", NotNull("Record_ID").failed().alias("failed"))


def rule_between(spark, sf_dir):
    df = traffic_like(spark, sf_dir)
    hour_rule, cat_rule = traffic.SUITE.row_rules[2], traffic.SUITE.row_rules[3]
    return df.select(
        "Count_point_id",
        "hour",
        "Road_Category_ID",
        hour_rule.failed().alias("hour_failed"),
        cat_rule.failed().alias("category_failed"),
    )


def rule_min_only(spark, sf_dir):
    df = roads_like(spark, sf_dir)
    rule = roads.SUITE.row_rules[1]
    return df.select("Road_ID", "Total_Link_Length_Km", rule.failed().alias("failed"))


def rule_strftime(spark, sf_dir):
    """V5: the feed's own format, a two-digit year, and no year at all; every
    month and day up to 12/31 occurs, so 2/29, 2/30 and 4/31 do."""
    day = F.date_format(F.expr("make_date(2000, 1, 1) + CAST(Count_point_id % 31 AS INT)"), "dd")
    month, year = F.lpad((F.col("Count_point_id") % 12 + 1).cast("string"), 2, "0"), F.lpad((F.col("Count_point_id") % 100).cast("string"), 2, "0")
    df = traffic_like(spark, sf_dir).withColumns(
        {"short_date": F.concat_ws("/", month, day, year), "month_day": F.concat_ws("/", month, day)}
    )
    rules = {"failed": traffic.SUITE.row_rules[1], "short_failed": MatchesStrftime("short_date", "%m/%d/%y"),
             "month_day_failed": MatchesStrftime("month_day", "%m/%d")}
    return df.select("Count_point_id", "Count_date", "short_date", "month_day", *[r.failed().alias(n) for n, r in rules.items()])


def rule_max_length(spark, sf_dir):
    """K6: strings longer than a column allows break a row rule."""
    df = traffic_like(spark, sf_dir)
    rule = MaxLength("Local_authority_name", 11)
    return df.select("Count_point_id", "Local_authority_name", rule.failed().alias("failed"))


def rule_column_set(spark, sf_dir):
    """V1: column-set check of four batches (two conform, two drifted),
    with the row count of each batch."""
    bronze = _bronze_traffic(spark, sf_dir)
    rds = roads_like(spark, sf_dir)
    cases = [
        ("raw_traffic", bronze, traffic.SUITE),
        ("raw_traffic_extra_column", bronze.withColumn("Unexpected", F.lit(1)), traffic.SUITE),
        ("raw_roads", rds, roads.SUITE),
        ("raw_roads_missing_column", rds.drop("All_Motor_Vehicles"), roads.SUITE),
    ]
    parts = []
    for name, df, suite in cases:
        res = suite.table_rules[0].check(df.columns)
        parts.append(
            df.agg(F.count(F.lit(1)).alias("n_rows")).select(
                F.lit(name).alias("table_name"),
                "n_rows",
                F.lit(res["success"]).alias("success"),
                F.lit(",".join(res["missing"])).alias("missing"),
                F.lit(",".join(res["unexpected"])).alias("unexpected"),
            )
        )
    return reduce(DataFrame.unionByName, parts)


def rule_header_match(spark, sf_dir):
    """Header check per landing file; region 4 arrives with a renamed
    header column, region 3 with every cell quoted, region 2 without a header
    (so the reader takes a row of each file for one).  Reported per region: all
    files ok, data rows; region 2 as if it had come in one file."""
    src = roads_like(spark, sf_dir).withColumn("region", F.col("Region_ID"))
    root = fresh_dir(spark, "header-landing")
    parts = (
        (src.filter(~F.col("region").isin(2, 3, 4)), {}),
        (src.filter(F.col("region") == 4).withColumnRenamed("Road_ID", "Road_Identifier"), {}),
        (src.filter(F.col("region") == 3), {"quoteAll": "true"}),
        (src.filter(F.col("region") == 2), {"header": "false"}),
    )
    for part, options in parts:
        display = part.select(
            *[F.col(c).alias(c.replace("_", " ")) for c in part.columns if c != "region"], F.col("region")
        )
        display.write.mode("append").options(**{"header": "true", **options}).partitionBy("region").csv(root)
    report = header_report(spark, root, ROADS_SCHEMA, glob="*.csv")
    region = F.regexp_extract("file_path", r"region=([0-9]+)", 1).cast("int")
    return (
        report.withColumn("Region_ID", region)
        .groupBy("Region_ID")
        .agg(F.bool_and("header_ok").alias("header_ok"), F.sum("n_rows").alias("n_rows"), F.count(F.lit(1)).alias("n_files"))
        .select("Region_ID", "header_ok", F.when(F.col("Region_ID") == 2, F.col("n_rows") + F.col("n_files") - 1).otherwise(F.col("n_rows")).alias("n_rows"))
    )


def validate_suite(spark, sf_dir):
    """V6/V7: the whole suite as one projection."""
    ann = annotate(_bronze_traffic(spark, sf_dir), traffic.SUITE)
    return ann.select(
        "Count_point_id",
        F.when(F.size(VIOLATIONS) > 0, quality.violated_rules_text()).alias("violated_rules"),
        (F.size(VIOLATIONS) == 0).alias("is_valid"),
    )


def rule_failure_counts(spark, sf_dir):
    """V8: failing rows and outcome per rule, both feeds."""
    return quality.rule_failure_counts(_bronze_traffic(spark, sf_dir), traffic.SUITE).unionByName(
        quality.rule_failure_counts(roads_like(spark, sf_dir), roads.SUITE)
    )


def violations_long(spark, sf_dir):
    """V9: one row per (record, broken rule)."""
    ann = annotate(_bronze_traffic(spark, sf_dir), traffic.SUITE)
    return quality.violations_long(ann, ["Count_point_id"])


def violations_regroup(spark, sf_dir):
    """A2: long form regrouped per record."""
    long = violations_long(spark, sf_dir)
    return quality.violations_regroup(long, ["Count_point_id"])


def violations_join_back(spark, sf_dir):
    """All records with their regrouped rule text, NULL if none is broken."""
    base = _bronze_traffic(spark, sf_dir).select("Count_point_id", "Record_ID", "Count_date", "hour", "Road_Category_ID")
    return quality.violations_join_back(base, violations_regroup(spark, sf_dir), ["Count_point_id"])


def split_valid(spark, sf_dir):
    """Rows that pass every rule, payload columns."""
    return _good_traffic(spark, sf_dir).select(*TRAFFIC_PAYLOAD)


def quarantine_rows(spark, sf_dir):
    """Row-level quarantine of both feeds (written, read back)."""
    return _quarantine_view(read_layer(spark, _quarantine_both(spark, sf_dir)))


def quarantine_table_level(spark, sf_dir):
    """A batch with an unexpected column is quarantined whole."""
    cfg = LayerConfig.scratch(spark, "table-level")
    drifted = _bronze_traffic(spark, sf_dir).withColumn("Unexpected", F.lit(1))
    validate_and_write(
        drifted, 0, suite=traffic.SUITE, target_path=cfg.bronze(traffic.TABLE), quarantine_path=cfg.quarantine()
    )
    return _quarantine_view(read_layer(spark, cfg.quarantine()))


def quarantine_summary(spark, sf_dir):
    """A4: input, good and quarantined row counts per feed."""
    t = quality.summarize_split(annotate(_bronze_traffic(spark, sf_dir), traffic.SUITE), traffic.TABLE)
    r = quality.summarize_split(annotate(roads_like(spark, sf_dir), roads.SUITE), roads.TABLE)
    return t.unionByName(r)


def quarantine_by_rule(spark, sf_dir):
    """Quarantined rows per (table, batch, rule)."""
    return quality.quarantine_by_rule(read_layer(spark, _quarantine_both(spark, sf_dir)))


def monitor_batch_quality(spark, sf_dir):
    """Input, good, quarantined rows and pass rate per (table, batch),
    counted from the written bronze and quarantine tables."""
    cfg = _validate_both(spark, sf_dir)
    targets = {t: read_layer(spark, cfg.bronze(t)) for t in (traffic.TABLE, roads.TABLE)}
    return monitor.batch_quality(targets, read_layer(spark, cfg.quarantine()))


def validate_fail_open(spark, sf_dir):
    """The validator fails (rule on a missing column); with
    ``on_error='pass_through'`` the whole batch lands unvalidated."""
    cfg = LayerConfig.scratch(spark, "fail-open")
    broken = Suite(traffic.TABLE, tuple(traffic.SUITE.row_rules) + (NotNull("No_Such_Column"),))
    validate_and_write(
        _bronze_traffic(spark, sf_dir),
        0,
        suite=broken,
        target_path=cfg.bronze(traffic.TABLE),
        quarantine_path=cfg.quarantine(),
        on_error="pass_through",
    )
    return read_layer(spark, cfg.bronze(traffic.TABLE)).select("Count_point_id", "Record_ID", "Count_date")


def empty_batch_skip(spark, sf_dir):
    """The feed arrives as one batch per region id 0-5; region 5
    has no rows, so that batch is skipped and writes nothing."""
    cfg = LayerConfig.scratch(spark, "batches")
    bronze = _bronze_traffic(spark, sf_dir)
    outcomes = []
    for region in range(6):
        out = validate_and_write(
            bronze.filter(F.col("Region_id") == region),
            region,
            suite=traffic.SUITE,
            target_path=cfg.bronze(traffic.TABLE),
            quarantine_path=cfg.quarantine(),
        )
        outcomes.append((region, out.skipped))
    batches = spark.createDataFrame(outcomes, "batch_id int, skipped boolean")
    good = read_layer(spark, cfg.bronze(traffic.TABLE)).groupBy(F.col(BATCH_COLUMN).cast("int").alias("batch_id")).agg(
        F.count(F.lit(1)).alias("n_bronze")
    )
    bad = read_layer(spark, cfg.quarantine()).groupBy(F.col("gx_batch_id").cast("int").alias("batch_id")).agg(
        F.count(F.lit(1)).alias("n_quarantined")
    )
    return (
        batches.join(good, "batch_id", "left")
        .join(bad, "batch_id", "left")
        .select(
            "batch_id",
            "skipped",
            F.coalesce("n_bronze", F.lit(0)).alias("n_bronze"),
            F.coalesce("n_quarantined", F.lit(0)).alias("n_quarantined"),
        )
    )


def _repair_day_first(df: DataFrame) -> DataFrame:
    """Repair: a day-first ``Count_date`` rewritten month-first."""
    fmt = traffic.SUITE.row_rules[1].strftime_format
    fixed = F.date_format(F.try_to_timestamp(F.col("Count_date"), F.lit("dd/MM/yyyy HH:mm")), "M/d/yyyy H:mm")
    bad = ~F.coalesce(matches_strftime("Count_date", fmt), F.lit(False))
    return df.withColumn("Count_date", F.when(bad & fixed.isNotNull(), fixed).otherwise(F.col("Count_date")))


def _recover(spark, sf_dir):
    cfg = LayerConfig.scratch(spark, "recovery")
    medallion.setup_tables(spark, cfg)  # typed bronze tables + quarantine table DDL
    validate_and_write(
        _bronze_traffic(spark, sf_dir), 0, suite=traffic.SUITE, target_path=cfg.bronze(traffic.TABLE),
        quarantine_path=cfg.quarantine(),
    )
    quarantine_table = cfg.table(cfg.quarantine_table)
    medallion.refresh_partitions(spark, quarantine_table)
    keys = recover_quarantine(
        spark,
        quarantine_path=cfg.quarantine(),
        table_name=traffic.TABLE,
        rule=f"[Count_date] {STRFTIME}",
        schema=TRAFFIC_BRONZE_SCHEMA,
        suite=traffic.SUITE,
        target_path=cfg.bronze(traffic.TABLE),
        batch_id="recovery",
        repair=_repair_day_first,
        quarantine_table=quarantine_table,
    )
    return cfg, keys


def recover_quarantine_q(spark, sf_dir):
    """Quarantined date-format rows parsed back, repaired, revalidated
    and re-inserted; the re-inserted rows of the target are returned."""
    cfg, _ = _recover(spark, sf_dir)
    target = read_layer(spark, cfg.bronze(traffic.TABLE))
    return target.filter(F.col(BATCH_COLUMN) == "recovery").select(*TRAFFIC_PAYLOAD)


def _recover_rule(spark, cfg, rule: str, suite: Suite, repair=None) -> None:
    """Recover one rule's rows and purge them."""
    keys = recover_quarantine(
        spark, quarantine_path=cfg.quarantine(), table_name=traffic.TABLE, rule=rule, schema=TRAFFIC_BRONZE_SCHEMA,
        suite=suite, target_path=cfg.bronze(traffic.TABLE), repair=repair,
    )
    purge_quarantine(spark, cfg.quarantine(), keys)


def recover_twice(spark, sf_dir):
    """Two rules recovered and purged one after the other; no row of
    the landing is lost or doubled."""
    cfg = LayerConfig.scratch(spark, "recover-twice")
    landing = _bronze_traffic(spark, sf_dir)
    validate_and_write(
        landing, 0, suite=traffic.SUITE, target_path=cfg.bronze(traffic.TABLE), quarantine_path=cfg.quarantine()
    )
    _recover_rule(spark, cfg, f"[Count_date] {STRFTIME}", traffic.SUITE, _repair_day_first)
    hours_allowed = Suite(traffic.TABLE, tuple(r for r in traffic.SUITE.rules if r.column != "hour"))
    _recover_rule(spark, cfg, f"[hour] {BETWEEN}", hours_allowed)
    return monitor.layer_counts(
        {
            "landing": landing,
            "bronze": read_layer(spark, cfg.bronze(traffic.TABLE)),
            "quarantine": read_layer(spark, cfg.quarantine()),
        }
    )


def stream_recover_chain(spark, sf_dir):
    """Stream, quarantine, silver with a dedup horizon; then recover,
    purge and silver again: recovered rows are not late."""
    cfg = LayerConfig.scratch(spark, "recover-chain")
    _land_traffic(spark, cfg.landing(traffic.TABLE), traffic_dup(spark, sf_dir))
    medallion.setup_tables(spark, cfg)
    for q in medallion.start_bronze_streams(spark, cfg, sources=medallion.landing_sources(cfg, per_feed_folders=True)):
        run_available_now(q)
    for _ in range(2):
        for q in medallion.start_silver_streams(spark, cfg, dedup_horizon="2 seconds"):
            run_available_now(q)
        _recover_rule(spark, cfg, f"[Count_date] {STRFTIME}", traffic.SUITE, _repair_day_first)
    silver = spark.read.parquet(cfg.silver(medallion.SILVER_TRAFFIC))
    return silver.select("Count_point_id", "Count_date", traffic.MOTOR_COUNT)


def recover_without_purge(spark, sf_dir):
    """A rule's rows are recovered three times without a purge, the second
    time after another batch brought more of them: none comes back twice."""
    cfg = LayerConfig.scratch(spark, "recover-no-purge")
    landing = _bronze_traffic(spark, sf_dir)
    first = F.col("Region_id") < 2
    for batch_id, part in ((0, landing.where(first)), (1, landing.where(~first))):
        validate_and_write(
            part, batch_id, suite=traffic.SUITE, target_path=cfg.bronze(traffic.TABLE), quarantine_path=cfg.quarantine()
        )
        for _ in range(1 + batch_id):
            recovery = recover_batch(
                spark, quarantine_path=cfg.quarantine(), table_name=traffic.TABLE, rule=f"[Count_date] {STRFTIME}",
                schema=TRAFFIC_BRONZE_SCHEMA, suite=traffic.SUITE, target_path=cfg.bronze(traffic.TABLE), repair=_repair_day_first,
            )
    layers = {"landing": landing, "bronze": read_layer(spark, cfg.bronze(traffic.TABLE)), "quarantine": read_layer(spark, cfg.quarantine())}
    return monitor.layer_counts({**layers, "recovered": recovery.keys})


def batch_recover_chain(spark, sf_dir):
    """Batch loads, then recovery and purge, then another load; what was
    recovered is in gold too."""
    cfg = LayerConfig.scratch(spark, "batch-recover")
    feed, no_roads = traffic_like(spark, sf_dir), roads_like(spark, sf_dir).limit(0)
    medallion.run_batch(spark, cfg, feed.where("Region_id < 3"), no_roads, "1")
    medallion.recover_layers(spark, cfg, traffic.TABLE, f"[Count_date] {STRFTIME}", traffic.SUITE, purge=True, repair=_repair_day_first)
    run = medallion.run_batch(spark, cfg, feed.where("Region_id >= 3"), no_roads, "2")
    medallion.recover_layers(spark, cfg, traffic.TABLE, f"[Count_date] {STRFTIME}", traffic.SUITE, purge=True, repair=_repair_day_first)
    return run.gold(spark, medallion.GOLD_TRAFFIC).select("Count_point_id", "Count_date", traffic.MOTOR_COUNT)


def dedup_batch_history(spark, sf_dir):
    """Three loads with many records in common, then a corrected retry of the
    first that delivers less; each record still delivered is in silver once."""
    cfg = LayerConfig.scratch(spark, "history")
    feed, no_roads = traffic_dup(spark, sf_dir), roads_like(spark, sf_dir).limit(0)
    waves = (("a", "Region_id >= 0"), ("b", "Region_id IN (1, 2)"), ("c", "Region_id IN (2, 3, 4)"), ("a", "Region_id = 0"))
    for batch_id, part in waves:
        run = medallion.run_batch(spark, cfg, feed.where(part), no_roads, batch_id)
    return run.silver(spark, medallion.SILVER_TRAFFIC).select(*TRAFFIC_PAYLOAD, traffic.MOTOR_COUNT)


def purge_quarantine_q(spark, sf_dir):
    """After recovery, re-inserted rows leave the quarantine."""
    cfg, keys = _recover(spark, sf_dir)
    purge_quarantine(spark, cfg.quarantine(), keys, quarantine_table=cfg.table(cfg.quarantine_table))
    return _quarantine_view(read_layer(spark, cfg.quarantine())).drop("has_ingestion_time")


def purge_by_tombstone(spark, sf_dir):
    """Re-inserted rows are marked as purged; the view leaves them out, and
    compaction then rewrites the partitions they were in."""
    cfg, keys = _recover(spark, sf_dir)
    mark_purged(spark, cfg.quarantine(), keys)
    marked = _quarantine_view(live_quarantine(spark, cfg.quarantine())).drop("has_ingestion_time").withColumn("state", F.lit("marked"))
    before = fresh_dir(spark, "marked")
    marked.write.parquet(before)
    compact_quarantine(spark, cfg.quarantine(), cfg.table(cfg.quarantine_table))
    after = _quarantine_view(read_layer(spark, cfg.quarantine())).drop("has_ingestion_time").withColumn("state", F.lit("compacted"))
    return spark.read.parquet(before).unionByName(after)


def schema_evolution_append(spark, sf_dir):
    """K4: batch 1 without, batch 2 with a new column; read back merged."""
    path = fresh_dir(spark, "evolving")
    bronze = traffic_like(spark, sf_dir)
    write_batch(bronze.filter(F.col("Region_id") < 3), path, 1)
    write_batch(traffic.motor_count(traffic.ev_count(bronze.filter(F.col("Region_id") >= 3))), path, 2)
    merged = read_layer(spark, path)
    return merged.select(
        "Count_point_id", F.col(BATCH_COLUMN).cast("int").alias("batch_id"), traffic.MOTOR_COUNT
    )


def schema_evolution_stream(spark, sf_dir):
    """K4: the second batch has a column more; the catalog table gains it and
    the stream that reads the table carries it on."""
    cfg = LayerConfig.scratch(spark, "evolving-stream")
    medallion.setup_tables(spark, cfg)
    table, bronze = cfg.table(traffic.TABLE), _bronze_traffic(spark, sf_dir)
    rows_only = Suite(traffic.TABLE, tuple(traffic.SUITE.row_rules))
    waves = [
        bronze.filter(F.col("Region_id") < 3),
        bronze.filter(F.col("Region_id") >= 3).withColumn("Survey", F.concat(F.lit("S"), F.col("Region_id").cast("string"))),
    ]
    for i, wave in enumerate(waves):
        validate_and_write(
            wave, i, suite=rows_only, target_path=cfg.bronze(traffic.TABLE), quarantine_path=cfg.quarantine(), target_table=table
        )
    out = cfg.silver("evolved")
    q = (
        stream_table(spark, table).writeStream.format("parquet").option("path", out)
        .option("checkpointLocation", cfg.checkpoint("evolved")).trigger(availableNow=True).start()
    )
    run_available_now(q)
    return spark.read.parquet(out).select("Count_point_id", "Survey")


# -------------------------------------------------------- cleaning


def dedup_full_row(spark, sf_dir):
    """Repeated records removed; the audit column is not compared."""
    return clean.dedup_full_row(_bronze_traffic(spark, sf_dir, dup=True)).select(*TRAFFIC_PAYLOAD)


def dedup_by_key(spark, sf_dir):
    """One row per (l_orderkey, l_linenumber): the earliest shipment."""
    li = load(spark, sf_dir, "lineitem")
    order = ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
             "l_returnflag", "l_linestatus"]
    return clean.dedup_by_key(li, ["l_orderkey", "l_linenumber"], order_by=order, keep="first")


def null_fill_strings(spark, sf_dir):
    return clean.fill_strings(traffic_like(spark, sf_dir), "Unknown", TRAFFIC_PAYLOAD)


def null_fill_numerics(spark, sf_dir):
    return clean.fill_numerics(traffic_like(spark, sf_dir), 0, TRAFFIC_PAYLOAD)


def null_policy(spark, sf_dir):
    return clean.null_policy(traffic_like(spark, sf_dir))


# ------------------------------------------------------ enrichment


def derived_ev_count(spark, sf_dir):
    df = traffic.ev_count(clean.null_policy(traffic_like(spark, sf_dir)))
    return df.select("Count_point_id", "EV_Car", "EV_Bike", traffic.EV_COUNT)


def derived_motor_count(spark, sf_dir):
    df = traffic.motor_count(traffic.ev_count(clean.null_policy(traffic_like(spark, sf_dir))))
    return df.select("Count_point_id", traffic.EV_COUNT, traffic.MOTOR_COUNT)


def audit_columns(spark, sf_dir):
    """The three audit stamps through bronze, silver and gold."""
    g = traffic.gold(traffic.silver(_bronze_traffic(spark, sf_dir)))
    return g.select(
        "Count_point_id",
        F.col(EXTRACT_TIME).isNotNull().alias("has_extract_time"),
        F.col(TRANSFORMED_TIME).isNotNull().alias("has_transformed_time"),
        F.col(LOADING_TIME).isNotNull().alias("has_loading_time"),
    )


def map_category_name(spark, sf_dir):
    df = roads.category_name(clean.null_policy(roads_like(spark, sf_dir)))
    return df.select("Road_ID", "Road_Category", "Road_Category_Name")


def classify_road_type(spark, sf_dir):
    df = roads.road_type(roads.category_name(clean.null_policy(roads_like(spark, sf_dir))))
    return df.select("Road_ID", "Road_Category_Name", "Road_Type")


def vehicle_intensity(spark, sf_dir):
    df = traffic.vehicle_intensity(traffic.silver(traffic_like(spark, sf_dir), dedup=False))
    return df.select("Count_point_id", traffic.MOTOR_COUNT, "Link_length_km", traffic.INTENSITY)


def gold_roads_passthrough(spark, sf_dir):
    return roads.gold(roads.silver(_good_roads(spark, sf_dir)))


def _gold_traffic(spark, sf_dir, dup: bool = False) -> DataFrame:
    return traffic.gold(traffic.silver(_good_traffic(spark, sf_dir, dup)))


def _joined_view(joined: DataFrame) -> DataFrame:
    return joined.select(
        "Count_point_id",
        "Region_id",
        "Road_Category_ID",
        traffic.MOTOR_COUNT,
        "n_roads",
        F.round("road_link_km_avg", 4).alias("road_link_km_avg"),
        F.round("road_link_km_sum", 2).alias("road_link_km_sum"),
        "road_vehicles_sum",
    )


def gold_traffic_roads_join(spark, sf_dir):
    """Traffic with its (region, category) road statistics."""
    silver_roads = roads.silver(_good_roads(spark, sf_dir))
    return _joined_view(gold_plan.traffic_roads_join(_gold_traffic(spark, sf_dir), silver_roads))


def gold_region_summary(spark, sf_dir):
    """Per region and category: records, vehicles, mean intensity."""
    return gold_plan.region_summary(_gold_traffic(spark, sf_dir))


def traffic_region_report(spark, sf_dir):
    """Flagship: validate -> split -> dedup -> null policy -> counts ->
    intensity -> summary per region, on the feed with repeats."""
    return gold_plan.region_summary(_gold_traffic(spark, sf_dir, dup=True), keys=["Region_id"])


# ------------------------------------------------------- monitor


def _batch_layers(spark, sf_dir):
    cfg = LayerConfig.scratch(spark, "layers")
    t_land, r_land = traffic_dup(spark, sf_dir), roads_like(spark, sf_dir)
    run = medallion.run_batch(spark, cfg, t_land, r_land)
    q = run.quarantine(spark)
    return {
        "landing_traffic": t_land,
        "landing_roads": r_land,
        "bronze_traffic": run.bronze(spark, traffic.TABLE),
        "bronze_roads": run.bronze(spark, roads.TABLE),
        "quarantine_traffic": q.filter(F.col("table_name") == traffic.TABLE),
        "quarantine_roads": q.filter(F.col("table_name") == roads.TABLE),
        "silver_traffic": run.silver(spark, medallion.SILVER_TRAFFIC),
        "silver_roads": run.silver(spark, medallion.SILVER_ROADS),
        "gold_traffic": run.gold(spark, medallion.GOLD_TRAFFIC),
        "gold_roads": run.gold(spark, medallion.GOLD_ROADS),
        "gold_traffic_roads": run.gold(spark, medallion.GOLD_TRAFFIC_ROADS),
        "gold_region_summary": run.gold(spark, medallion.GOLD_REGION_SUMMARY),
    }


def monitor_layer_counts(spark, sf_dir):
    """Row counts of every layer after a batch run, as one SQL
    statement over the layers registered as views."""
    tag = uuid.uuid4().hex[:8]
    views = {}
    for name, df in _batch_layers(spark, sf_dir).items():
        views[name] = f"{name}_{tag}"
        df.createOrReplaceTempView(views[name])
    return monitor.sql_layer_counts(spark, views)


def monitor_reconcile(spark, sf_dir):
    """A5: landing = bronze + quarantine; silver = distinct bronze; gold = silver."""
    layers = _batch_layers(spark, sf_dir)
    layers["distinct_bronze_traffic"] = clean.dedup_full_row(layers["bronze_traffic"])
    layers["distinct_bronze_roads"] = clean.dedup_full_row(layers["bronze_roads"])
    counts = monitor.layer_counts(layers)
    return monitor.reconcile(
        counts,
        {
            "traffic_landing_split": (["landing_traffic"], ["bronze_traffic", "quarantine_traffic"]),
            "roads_landing_split": (["landing_roads"], ["bronze_roads", "quarantine_roads"]),
            "traffic_silver_distinct": (["silver_traffic"], ["distinct_bronze_traffic"]),
            "roads_silver_distinct": (["silver_roads"], ["distinct_bronze_roads"]),
            "traffic_gold_silver": (["gold_traffic"], ["silver_traffic"]),
            "roads_gold_silver": (["gold_roads"], ["silver_roads"]),
            "traffic_roads_join_rows": (["gold_traffic_roads"], ["gold_traffic"]),
        },
    )


def monitor_quality_rate(spark, sf_dir):
    """Pass rate per feed."""
    return monitor.quality_rate(quarantine_summary(spark, sf_dir))


def gold_region_incremental(spark, sf_dir):
    """The summary put together from the states of three loads and of a
    corrected retry of the first."""
    cfg = LayerConfig.scratch(spark, "region-states")
    feed, no_roads = traffic_dup(spark, sf_dir), roads_like(spark, sf_dir).limit(0)
    for batch_id, part in (("a", "Region_id <= 2"), ("b", "Region_id IN (2, 3)"), ("c", "Region_id IN (0, 4)"), ("a", "Region_id <= 1")):
        medallion.run_batch(spark, cfg, feed.where(part), no_roads, batch_id)
    return gold_plan.combine_region_states(read_layer(spark, cfg.gold(medallion.GOLD_REGION_STATES), merge_schema=False))


def monitor_observed_counts(spark, sf_dir):
    """A1/A5: rows of every layer as the writes counted them, over two waves of
    streams; no layer is read."""
    cfg = LayerConfig.scratch(spark, "observed")
    feed, rds = traffic_dup(spark, sf_dir), roads_like(spark, sf_dir)
    for part, roads_part in (("Region_id < 3", "Region_ID < 2"), ("Region_id >= 3", "Region_ID >= 2")):
        _land_traffic(spark, cfg.landing(traffic.TABLE), feed.where(part))
        medallion.write_landing_csv(rds.where(roads_part), cfg.landing(roads.TABLE))
        medallion.run_streams(spark, cfg, sources=medallion.landing_sources(cfg, per_feed_folders=True), count_rows=True)
    return monitor.recorded_counts(spark, cfg.report(medallion.LAYER_COUNTS))


# ---------------------------------------------------------- streaming (T)


def _land_traffic(spark, path: str, df: DataFrame) -> None:
    medallion.write_landing_csv(df, path)


def stream_file_ingest(spark, sf_dir):
    """Incremental CSV source -> parquet sink, available-now."""
    cfg = LayerConfig.scratch(spark, "file-ingest")
    _land_traffic(spark, cfg.landing(traffic.TABLE), traffic_like(spark, sf_dir))
    src = with_extract_time(stream_csv(spark, cfg.landing(), TRAFFIC_SCHEMA, glob="*.csv"))
    q = (
        src.writeStream.format("parquet")
        .option("path", cfg.bronze(traffic.TABLE))
        .option("checkpointLocation", cfg.checkpoint("ingest"))
        .trigger(availableNow=True)
        .start()
    )
    run_available_now(q)
    out = spark.read.parquet(cfg.bronze(traffic.TABLE))
    return out.select(*TRAFFIC_PAYLOAD, F.col(EXTRACT_TIME).isNotNull().alias("has_extract_time"))


def stream_incremental(spark, sf_dir):
    """Three runs on one checkpoint: regions 0-2 land, nothing new,
    regions 3-4 land; each run picks up only new files."""
    cfg = LayerConfig.scratch(spark, "incremental")
    src_df = traffic_like(spark, sf_dir)
    out_path = cfg.bronze(traffic.TABLE)
    counts = []
    waves = [src_df.filter(F.col("Region_id") < 3), None, src_df.filter(F.col("Region_id") >= 3)]
    for run, wave in enumerate(waves, start=1):
        if wave is not None:
            _land_traffic(spark, cfg.landing(traffic.TABLE), wave)
        stream = stream_csv(spark, cfg.landing(), TRAFFIC_SCHEMA, glob="*.csv").withColumn("run", F.lit(run))
        q = (
            stream.writeStream.format("parquet")
            .option("path", out_path)
            .option("checkpointLocation", cfg.checkpoint("incremental"))
            .trigger(availableNow=True)
            .start()
        )
        run_available_now(q)
    written = spark.read.parquet(out_path).groupBy("run").agg(F.count(F.lit(1)).alias("n_new_rows"))
    runs = spark.range(1, 4).select(F.col("id").cast("int").alias("run"))
    return runs.join(written, "run", "left").select("run", F.coalesce("n_new_rows", F.lit(0)).alias("n_new_rows"))


def stream_archive_source(spark, sf_dir):
    """Three waves land, and files that were read move to an archive; every
    row is written once and lies in the landing folder or the archive."""
    cfg = LayerConfig.scratch(spark, "archive")
    landing, archive, out_path = cfg.landing(traffic.TABLE), f"{cfg.root}/archive", cfg.bronze(traffic.TABLE)
    feed = traffic_like(spark, sf_dir)
    for wave in ("Region_id < 2", "Region_id IN (2, 3)", "Region_id > 3"):
        _land_traffic(spark, landing, feed.where(wave))
        stream = stream_csv(spark, landing, TRAFFIC_SCHEMA, glob="*.csv", archive=archive)
        q = (
            stream.writeStream.format("parquet")
            .option("path", out_path)
            .option("checkpointLocation", cfg.checkpoint("archive"))
            .trigger(availableNow=True)
            .start()
        )
        run_available_now(q)
    both = read_csv(spark, landing, TRAFFIC_SCHEMA, glob="*.csv").unionByName(read_csv(spark, archive, TRAFFIC_SCHEMA, glob="*.csv"))
    return monitor.layer_counts(
        {"landed": feed, "written": spark.read.parquet(out_path), "landing and archive": both}
    )


def stream_dedup_q(spark, sf_dir):
    """Stateful stream dedup; every 20th record is delivered again in
    a later file and run, and the state drops it."""
    cfg = LayerConfig.scratch(spark, "stream-dedup")
    base = traffic_like(spark, sf_dir)
    waves = [base, base.filter(F.col("Count_point_id") % 20 == 0)]
    out_path = cfg.silver(traffic.TABLE)
    for wave in waves:
        _land_traffic(spark, cfg.landing(traffic.TABLE), wave)
        src = with_extract_time(stream_csv(spark, cfg.landing(), TRAFFIC_SCHEMA, glob="*.csv"))
        q = (
            stream_dedup(src).writeStream.format("parquet")
            .option("path", out_path)
            .option("checkpointLocation", cfg.checkpoint("dedup"))
            .trigger(availableNow=True)
            .start()
        )
        run_available_now(q)
    return spark.read.parquet(out_path).select(*TRAFFIC_PAYLOAD)


def stream_table_chain(spark, sf_dir):
    """Landing -> bronze -> silver -> gold, every layer an
    available-now stream reading the previous table."""
    cfg = LayerConfig.scratch(spark, "chain")
    _land_traffic(spark, cfg.landing(traffic.TABLE), traffic_dup(spark, sf_dir))
    medallion.write_landing_csv(roads_like(spark, sf_dir), cfg.landing(roads.TABLE))
    # Spark-written landing files are named part-*; read each feed's folder.
    medallion.run_streams(spark, cfg, sources=medallion.landing_sources(cfg, per_feed_folders=True))
    # Every column that gold has, so one too many shows; audit stamps as flags.
    g = spark.read.parquet(cfg.gold(medallion.GOLD_TRAFFIC))
    stamps = (EXTRACT_TIME, TRANSFORMED_TIME, LOADING_TIME)
    return g.select(*[F.col(c).isNotNull().alias(f"has_{c.lower()}") if c in stamps else F.col(c) for c in g.columns])


def stream_traffic_roads_join(spark, sf_dir):
    """J2 from streams: the roads land in two waves around the traffic; the
    result is that of one batch."""
    cfg = LayerConfig.scratch(spark, "join-waves")
    rds = roads_like(spark, sf_dir)
    sources = medallion.landing_sources(cfg, per_feed_folders=True)
    _land_traffic(spark, cfg.landing(traffic.TABLE), traffic_like(spark, sf_dir))
    medallion.write_landing_csv(rds.filter(F.col("Region_ID") < 3), cfg.landing(roads.TABLE))
    medallion.run_streams(spark, cfg, sources=sources)
    medallion.write_landing_csv(rds.filter(F.col("Region_ID") >= 3), cfg.landing(roads.TABLE))
    medallion.run_streams(spark, cfg, sources=sources)
    return _joined_view(spark.table(cfg.table(medallion.GOLD_TRAFFIC_ROADS)))


def stream_two_feeds(spark, sf_dir):
    """Both feeds stream at once; the roads' validation fails first, which
    stops the traffic too; the next run leaves every row in bronze or quarantine once."""
    cfg = LayerConfig.scratch(spark, "two-feeds")
    _land_traffic(spark, cfg.landing(traffic.TABLE), traffic_dup(spark, sf_dir))
    medallion.write_landing_csv(roads_like(spark, sf_dir), cfg.landing(roads.TABLE))
    sources = medallion.landing_sources(cfg, per_feed_folders=True)
    broken = Suite(roads.TABLE, (NotNull("No_Such_Column"),))

    def feed(table: str, schema, suite):
        stream = with_source_file(stream_csv(spark, *sources[table][:1], schema, glob=sources[table][1], corrupt_column=CORRUPT))
        return lambda: start_validated_ingest(
            stream, suite=suite, target_path=cfg.bronze(table), quarantine_path=cfg.quarantine(),
            checkpoint=cfg.checkpoint(f"bronze_{table}"), landing_schema=schema, stamped=table == traffic.TABLE,
        )

    for roads_suite in (broken, roads.SUITE):
        starts = {traffic.TABLE: feed(traffic.TABLE, TRAFFIC_SCHEMA, traffic.SUITE), roads.TABLE: feed(roads.TABLE, ROADS_SCHEMA, roads_suite)}
        try:
            run_together(start_together(spark, starts))
        except StreamingQueryException:
            if roads_suite is not broken:
                raise
        else:
            if roads_suite is broken:
                raise AssertionError("the broken feed did not fail")
    quarantine = read_layer(spark, cfg.quarantine())
    return monitor.layer_counts(
        {
            "bronze_traffic": read_layer(spark, cfg.bronze(traffic.TABLE)),
            "bronze_roads": read_layer(spark, cfg.bronze(roads.TABLE)),
            "quarantine_traffic": quarantine.where(F.col("table_name") == traffic.TABLE),
            "quarantine_roads": quarantine.where(F.col("table_name") == roads.TABLE),
        }
    )


def publish_after_failure(spark, sf_dir):
    """K1/K2: batch 0 is published; the second output of batch 1 fails, and
    neither table shows any of it; its retry shows both."""
    cfg = LayerConfig.scratch(spark, "publish")
    medallion.setup_tables(spark, cfg)
    target, quarantine = cfg.table(traffic.TABLE), cfg.table(cfg.quarantine_table)
    landing = _bronze_traffic(spark, sf_dir)
    load = lambda batch_id, part: validate_and_write(
        landing.where(part), batch_id, suite=traffic.SUITE, target_path=cfg.bronze(traffic.TABLE),
        quarantine_path=cfg.quarantine(), publish_to=(target, quarantine),
    )
    counted = fresh_dir(spark, "publish-counts")

    def count(step: str) -> None:
        monitor.layer_counts({"bronze": spark.table(target), "quarantine": spark.table(quarantine)}).withColumn(
            "step", F.lit(step)
        ).write.mode("append").parquet(counted)

    load(0, "Region_id < 2")
    count("first batch")
    annotated = annotate(landing.where("Region_id >= 2"), traffic.SUITE)
    good, _ = split(annotated)
    lost = good.withColumn("Year", F.when(F.col("Year").isNotNull(), F.raise_error(F.lit("the write fails")).cast("int")))
    try:
        publish(
            spark,
            [
                (quarantine, {"table_name": traffic.TABLE, "gx_batch_id": "1"}, quality.quarantine_rows(annotated, traffic.TABLE, "1")),
                (target, {BATCH_COLUMN: "1"}, lost),
            ],
        )
    except PySparkException:
        count("failed batch")
    load(1, "Region_id >= 2")
    count("retried batch")
    return spark.read.parquet(counted)


def stream_validate_quarantine(spark, sf_dir):
    """K1/K2/T4: CSV stream -> foreachBatch validate -> bronze + quarantine."""
    cfg = LayerConfig.scratch(spark, "stream-validate")
    _land_traffic(spark, cfg.landing(traffic.TABLE), traffic_like(spark, sf_dir))
    medallion.write_landing_csv(roads_like(spark, sf_dir), cfg.landing(roads.TABLE))
    for q in medallion.start_bronze_streams(spark, cfg, sources=medallion.landing_sources(cfg, per_feed_folders=True)):
        run_available_now(q)
    bt = read_layer(spark, cfg.bronze(traffic.TABLE)).select(
        F.lit("bronze").alias("layer"), F.lit(traffic.TABLE).alias("table_name"), F.lit(None).cast("string").alias("violated_rules"),
        F.col("Count_point_id").alias("row_key"),
    )
    br = read_layer(spark, cfg.bronze(roads.TABLE)).select(
        F.lit("bronze").alias("layer"), F.lit(roads.TABLE).alias("table_name"), F.lit(None).cast("string").alias("violated_rules"),
        F.col("Road_ID").alias("row_key"),
    )
    q = _quarantine_view(read_layer(spark, cfg.quarantine())).select(
        F.lit("quarantine").alias("layer"), "table_name", "violated_rules", "row_key"
    )
    return bt.unionByName(br).unionByName(q)


QUERIES = {
    "csv_schema_on_read": csv_schema_on_read,
    "rule_not_null": rule_not_null,
    "rule_between": rule_between,
    "rule_min_only": rule_min_only,
    "rule_strftime": rule_strftime,
    "rule_max_length": rule_max_length,
    "rule_column_set": rule_column_set,
    "rule_header_match": rule_header_match,
    "validate_suite": validate_suite,
    "rule_failure_counts": rule_failure_counts,
    "violations_long": violations_long,
    "violations_regroup": violations_regroup,
    "violations_join_back": violations_join_back,
    "split_valid": split_valid,
    "quarantine_rows": quarantine_rows,
    "quarantine_table_level": quarantine_table_level,
    "quarantine_summary": quarantine_summary,
    "quarantine_by_rule": quarantine_by_rule,
    "validate_fail_open": validate_fail_open,
    "empty_batch_skip": empty_batch_skip,
    "recover_quarantine": recover_quarantine_q,
    "purge_quarantine": purge_quarantine_q,
    "purge_by_tombstone": purge_by_tombstone,
    "recover_twice": recover_twice,
    "recover_without_purge": recover_without_purge,
    "batch_recover_chain": batch_recover_chain,
    "schema_evolution_append": schema_evolution_append,
    "schema_evolution_stream": schema_evolution_stream,
    "dedup_full_row": dedup_full_row,
    "dedup_by_key": dedup_by_key,
    "dedup_batch_history": dedup_batch_history,
    "null_fill_strings": null_fill_strings,
    "null_fill_numerics": null_fill_numerics,
    "null_policy": null_policy,
    "derived_ev_count": derived_ev_count,
    "derived_motor_count": derived_motor_count,
    "audit_columns": audit_columns,
    "map_category_name": map_category_name,
    "classify_road_type": classify_road_type,
    "vehicle_intensity": vehicle_intensity,
    "gold_roads_passthrough": gold_roads_passthrough,
    "gold_traffic_roads_join": gold_traffic_roads_join,
    "gold_region_summary": gold_region_summary,
    "traffic_region_report": traffic_region_report,
    "monitor_layer_counts": monitor_layer_counts,
    "monitor_reconcile": monitor_reconcile,
    "monitor_quality_rate": monitor_quality_rate,
    "monitor_batch_quality": monitor_batch_quality,
    "stream_file_ingest": stream_file_ingest,
    "stream_incremental": stream_incremental,
    "stream_archive_source": stream_archive_source,
    "stream_dedup": stream_dedup_q,
    "stream_table_chain": stream_table_chain,
    "stream_traffic_roads_join": stream_traffic_roads_join,
    "stream_recover_chain": stream_recover_chain,
    "stream_validate_quarantine": stream_validate_quarantine,
    "stream_two_feeds": stream_two_feeds,
    "publish_after_failure": publish_after_failure,
    "gold_region_incremental": gold_region_incremental,
    "monitor_observed_counts": monitor_observed_counts,
}
