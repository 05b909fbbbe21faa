"""Layer runs of the traffic and roads feeds, batch and streaming.

``run_batch`` loads two landing DataFrames as one batch through bronze
(validated, quarantined), silver and gold, writing every layer under a
``LayerConfig``.  ``run_streams`` does the same from CSV landing folders with
available-now streams: file -> bronze (foreachBatch) -> silver -> gold.  Both
also give the two gold reports: traffic joined with per-key road statistics (as
they are when it is read) and the regional summary.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from strata import labels
from strata.config import LayerConfig
from strata.operators.clean import payload_digest
from strata.operators.monitor import CountedStreams
from strata.operators.quarantine import Recovery, purge_quarantine, recover_batch, validate_and_write
from strata.operators.rules import Suite
from strata.plans import gold as gold_plan
from strata.plans import roads, traffic
from strata.schemas import (
    BATCH_COLUMN,
    EXTRACT_TIME,
    QUARANTINE_COMMENTS,
    QUARANTINE_SCHEMA,
    ROADS_BRONZE_SCHEMA,
    ROADS_SCHEMA,
    TRAFFIC_BRONZE_SCHEMA,
    TRAFFIC_SCHEMA,
)
from strata.sinks.history import KEY, DeliveryIndex
from strata.sinks.tables import (
    create_database,
    create_table,
    drop_partition,
    layer_exists,
    partition_values,
    path_exists,
    read_layer,
    read_partition,
    write_batch,
)
from strata.sources.files import CORRUPT, stream_csv, with_extract_time, with_source_file
from strata.sources.tables import MAX_BYTES_PER_TRIGGER, stream_table
from strata.streaming.chain import start_table_stream, stream_dedup
from strata.streaming.ingest import run_together, start_together, start_validated_ingest

SILVER_TRAFFIC = "silver_traffic"
SILVER_ROADS = "silver_roads"
GOLD_TRAFFIC = "gold_traffic"
GOLD_ROADS = "gold_roads"
GOLD_TRAFFIC_ROADS = "gold_traffic_roads"
GOLD_REGION_SUMMARY = "gold_region_summary"
GOLD_REGION_STATES = "gold_region_states"
LAYER_COUNTS = "layer_counts"

# Bronze strings have at most 255 characters: longer ones are quarantined.
TRAFFIC_SUITE = traffic.SUITE.with_lengths(TRAFFIC_SCHEMA, 255)
ROADS_SUITE = roads.SUITE.with_lengths(ROADS_SCHEMA, 255)

def _with_batch(schema: StructType) -> StructType:
    return StructType(list(schema.fields) + [StructField(BATCH_COLUMN, StringType(), True)])


def setup_tables(spark: SparkSession, cfg: LayerConfig) -> None:
    """Database, typed bronze tables and the quarantine table (idempotent)."""
    create_database(spark, cfg.database, f"{cfg.root}/catalog")
    create_table(
        spark,
        cfg.table(traffic.TABLE),
        _with_batch(TRAFFIC_BRONZE_SCHEMA),
        cfg.bronze(traffic.TABLE),
        partitioned_by=[BATCH_COLUMN],
        varchar=255,
    )
    create_table(
        spark,
        cfg.table(roads.TABLE),
        _with_batch(ROADS_BRONZE_SCHEMA),
        cfg.bronze(roads.TABLE),
        partitioned_by=[BATCH_COLUMN],
        varchar=255,
    )
    create_table(
        spark,
        cfg.table(cfg.quarantine_table),
        QUARANTINE_SCHEMA,
        cfg.quarantine(),
        partitioned_by=["table_name", "gx_batch_id"],
        comment="Rows that failed data-quality validation",
        column_comments=QUARANTINE_COMMENTS,
    )
    register_layer_tables(spark, cfg)


def register_layer_tables(spark: SparkSession, cfg: LayerConfig) -> None:
    """Register silver and gold tables whose folders already exist.

    Stream sinks create these tables on their first run.  A later job in a
    new session without a persistent metastore finds the folders but no
    tables, so they are registered by location (schema read from the files,
    committed files only, through the sink's metadata log).
    """
    for name, path in (
        (SILVER_TRAFFIC, cfg.silver(SILVER_TRAFFIC)),
        (SILVER_ROADS, cfg.silver(SILVER_ROADS)),
        (GOLD_TRAFFIC, cfg.gold(GOLD_TRAFFIC)),
        (GOLD_ROADS, cfg.gold(GOLD_ROADS)),
        (GOLD_REGION_SUMMARY, cfg.gold(GOLD_REGION_SUMMARY)),
    ):
        if layer_exists(spark, path):
            spark.sql(f"CREATE TABLE IF NOT EXISTS `{cfg.database}`.`{name}` USING parquet LOCATION '{path}'")
    create_traffic_roads_view(spark, cfg)


def create_traffic_roads_view(spark: SparkSession, cfg: LayerConfig) -> None:
    """``gold_traffic_roads`` as a view of gold traffic and the roads known now.

    A stream that joined at arrival would freeze each row's road statistics,
    and give another answer than a batch run over the same data.
    """
    needed = ((GOLD_TRAFFIC, cfg.gold(GOLD_TRAFFIC)), (SILVER_ROADS, cfg.silver(SILVER_ROADS)))
    if all(spark.catalog.tableExists(cfg.table(name)) and layer_exists(spark, path) for name, path in needed):
        body = gold_plan.traffic_roads_sql(cfg.table(GOLD_TRAFFIC), cfg.table(SILVER_ROADS))
        spark.sql(f"CREATE OR REPLACE VIEW {cfg.table(GOLD_TRAFFIC_ROADS)} AS {body}")


def monitor_tables(spark: SparkSession, cfg: LayerConfig) -> DataFrame:
    """Row counts of every layer table that exists (one SQL statement, one
    job).  A layer whose folder has not been written yet is left out."""
    from strata.operators.monitor import sql_layer_counts

    locations = {
        traffic.TABLE: cfg.bronze(traffic.TABLE),
        roads.TABLE: cfg.bronze(roads.TABLE),
        SILVER_TRAFFIC: cfg.silver(SILVER_TRAFFIC),
        SILVER_ROADS: cfg.silver(SILVER_ROADS),
        GOLD_TRAFFIC: cfg.gold(GOLD_TRAFFIC),
        GOLD_ROADS: cfg.gold(GOLD_ROADS),
        GOLD_TRAFFIC_ROADS: cfg.gold(GOLD_TRAFFIC),  # a view of it
        GOLD_REGION_SUMMARY: cfg.gold(GOLD_REGION_SUMMARY),
        cfg.quarantine_table: cfg.quarantine(),
    }
    present = {r.tableName for r in spark.sql(f"SHOW TABLES IN `{cfg.database}`").collect()}
    counted = {}
    for name, path in locations.items():
        if name.lower() not in present or not layer_exists(spark, path):
            continue
        if name in (traffic.TABLE, roads.TABLE, cfg.quarantine_table):
            refresh_partitions(spark, cfg.table(name))  # partitions written by path
        counted[name] = cfg.table(name)
    return sql_layer_counts(spark, counted)


def refresh_partitions(spark: SparkSession, table: str) -> None:
    """Register partition folders written by path (batch writes) in the catalog."""
    spark.sql(f"ALTER TABLE {table} RECOVER PARTITIONS")


@dataclass(frozen=True)
class BatchRun:
    cfg: LayerConfig
    batch_id: str

    def bronze(self, spark: SparkSession, table: str) -> DataFrame:
        return read_layer(spark, self.cfg.bronze(table))

    def quarantine(self, spark: SparkSession) -> DataFrame:
        return read_layer(spark, self.cfg.quarantine())

    # Documented schemas: the batch label stays in bronze, and reads of tables
    # that one job writes skip the footer-by-footer schema merge.
    def silver(self, spark: SparkSession, table: str) -> DataFrame:
        return read_layer(spark, self.cfg.silver(table), merge_schema=False).drop(BATCH_COLUMN)

    def gold(self, spark: SparkSession, table: str) -> DataFrame:
        if table == GOLD_TRAFFIC_ROADS:  # joined as it is read: it shows the roads known now
            return gold_plan.traffic_roads_join(self.gold(spark, GOLD_TRAFFIC), self.silver(spark, SILVER_ROADS))
        return read_layer(spark, self.cfg.gold(table), merge_schema=False).drop(BATCH_COLUMN)


def _streamed(spark: SparkSession, path: str) -> bool:
    """Is a layer written by a stream (whose log lists all its files)?"""
    return path_exists(spark, f"{path}/_spark_metadata")


def append_new(spark: SparkSession, cfg: LayerConfig, module, bronze: str, silver: str, gold: str, label: str) -> None:
    """One bronze batch's new records into silver and gold, as that batch's partitions.

    The delivery index tells the new from those that other batches own.  A
    replaced batch first passes on what it no longer delivers, so a record stays
    as long as any batch delivers it.  Every step can be repeated: the batch's
    own index partition is written after those of the batches that take over.
    """
    if _streamed(spark, cfg.silver(silver)):
        return  # the streams of this root take the batch from bronze
    create_database(spark, cfg.database, f"{cfg.root}/catalog")
    index = DeliveryIndex.open(spark, cfg.table(f"{silver}_keys"), cfg.silver_keys(silver))
    with index.claim(spark, label):
        batch = read_partition(spark, cfg.bronze(bronze), {BATCH_COLUMN: label})
        if batch is None:
            keys = spark.createDataFrame([], f"{KEY} binary")
        else:
            keys = batch.select(payload_digest(batch).alias(KEY)).distinct()
        for other in index.pass_on(keys, label):
            write_owned(spark, cfg, index, module, bronze, silver, gold, other)
        index.write(index.flagged(keys, label), label)
        write_owned(spark, cfg, index, module, bronze, silver, gold, label)


def write_owned(spark: SparkSession, cfg: LayerConfig, index: DeliveryIndex, module, bronze: str, silver: str, gold: str, label: str) -> None:
    """The records that a batch owns become its partitions of silver and gold."""
    spec = {BATCH_COLUMN: label}
    batch = read_partition(spark, cfg.bronze(bronze), spec)
    owned = index.owned(spark, label)
    if batch is None or owned.isEmpty():
        for path in (cfg.silver(silver), cfg.gold(gold)):
            drop_partition(spark, path, spec)
        return
    rows = batch.withColumn(KEY, payload_digest(batch)).join(owned, KEY, "left_semi").dropDuplicates([KEY]).drop(KEY)
    write_batch(module.silver(rows, dedup=False), cfg.silver(silver), label)
    # Read back from its written table: the plan starts at a file scan.
    write_batch(module.gold(read_partition(spark, cfg.silver(silver), spec)), cfg.gold(gold), label)
    if gold == GOLD_TRAFFIC:
        write_region_state(spark, cfg, label)


def run_batch(
    spark: SparkSession,
    cfg: LayerConfig,
    traffic_landing: DataFrame,
    roads_landing: DataFrame,
    batch_id: str | None = None,
) -> BatchRun:
    """Load one landing batch of both feeds into bronze (validated, with
    quarantine), then its new records into silver and gold.

    Every layer gets the batch as a partition of its own; earlier batches are
    neither read (but for their record digests) nor rewritten, unless they take
    over records of a replaced one.  Give ``batch_id`` to make a repeated load
    replace its first attempt; without it every load is a new batch.  The regional
    summary is put together from the states of the batches.
    """
    label = labels.load(batch_id)
    quarantine = cfg.quarantine()
    # The two feeds are independent: each layer runs their jobs concurrently
    # from two driver threads (as the two bronze streams do), so a small
    # feed never leaves the cluster idle while the other one runs.
    run_concurrently(
        lambda: validate_and_write(
            with_extract_time(traffic_landing),
            label,
            suite=TRAFFIC_SUITE,
            target_path=cfg.bronze(traffic.TABLE),
            quarantine_path=quarantine,
        ),
        lambda: validate_and_write(
            roads_landing, label, suite=ROADS_SUITE, target_path=cfg.bronze(roads.TABLE), quarantine_path=quarantine
        ),
    )
    run_concurrently(
        lambda: append_new(spark, cfg, traffic, traffic.TABLE, SILVER_TRAFFIC, GOLD_TRAFFIC, label),
        lambda: append_new(spark, cfg, roads, roads.TABLE, SILVER_ROADS, GOLD_ROADS, label),
    )
    refresh_batch_reports(spark, cfg)
    return BatchRun(cfg, label)


def refresh_batch_reports(spark: SparkSession, cfg: LayerConfig) -> None:
    """The regional summary of a root of batch loads, put together from the states
    of its batches.  Only batches that have none are read (loads before states
    were kept); a replaced or emptied batch has replaced its state."""
    if _streamed(spark, cfg.gold(GOLD_TRAFFIC)):
        refresh_gold_reports(spark, cfg)
        return
    have, kept = (set(partition_values(spark, cfg.gold(name), BATCH_COLUMN)) for name in (GOLD_REGION_STATES, GOLD_TRAFFIC))
    for label in have - kept:
        drop_partition(spark, cfg.gold(GOLD_REGION_STATES), {BATCH_COLUMN: label})
    for label in kept - have:
        write_region_state(spark, cfg, label)
    if layer_exists(spark, cfg.gold(GOLD_REGION_STATES)):
        states = read_layer(spark, cfg.gold(GOLD_REGION_STATES), merge_schema=False)
        _write_summary(spark, cfg, gold_plan.combine_region_states(states))


def write_region_state(spark: SparkSession, cfg: LayerConfig, label: str) -> None:
    """One batch's part of the regional summary."""
    rows = read_partition(spark, cfg.gold(GOLD_TRAFFIC), {BATCH_COLUMN: label})
    if rows is None:
        drop_partition(spark, cfg.gold(GOLD_REGION_STATES), {BATCH_COLUMN: label})
    else:
        write_batch(gold_plan.region_states(rows).coalesce(1), cfg.gold(GOLD_REGION_STATES), label)


#: By feed: its rules, bronze schema, module and layer tables.
FEEDS = {
    traffic.TABLE: (TRAFFIC_SUITE, TRAFFIC_BRONZE_SCHEMA, traffic, SILVER_TRAFFIC, GOLD_TRAFFIC),
    roads.TABLE: (ROADS_SUITE, ROADS_BRONZE_SCHEMA, roads, SILVER_ROADS, GOLD_ROADS),
}


def recover_layers(
    spark: SparkSession, cfg: LayerConfig, table: str, rule: str | None = None, suite: Suite | None = None, purge: bool = False, **how
) -> Recovery:
    """Recover a feed's quarantined rows and, where batch loads own the layers
    above, take them through silver, gold and the reports; streams find them in
    bronze by themselves.  The rows leave the quarantine (``purge``) at the end, so
    a recovery that failed on its way is simply run again."""
    known, schema, module, silver, gold = FEEDS[table]
    recovery = recover_batch(
        spark, quarantine_path=cfg.quarantine(), table_name=table, rule=rule, schema=schema, suite=suite or known,
        target_path=cfg.bronze(table), **how,
    )
    if recovery.labels and path_exists(spark, cfg.silver_keys(silver)):
        for label in recovery.labels:
            append_new(spark, cfg, module, table, silver, gold, label)
        refresh_batch_reports(spark, cfg)
    if purge:
        purge_quarantine(spark, cfg.quarantine(), recovery.keys, quarantine_table=how.get("quarantine_table"))
    return recovery


def run_concurrently(*jobs) -> list:
    """Run independent driver-side job submissions in parallel threads and
    re-raise the first failure."""
    with ThreadPoolExecutor(max_workers=len(jobs)) as pool:
        futures = [pool.submit(job) for job in jobs]
        return [f.result() for f in futures]


def write_landing_csv(df: DataFrame, path: str, display_header: bool = True) -> None:
    """Drop a DataFrame into a landing folder as CSV files with a header line.

    With ``display_header`` the header uses blanks instead of underscores,
    as exported files do; the reader assigns columns by position anyway.
    """
    out = df
    if display_header:
        out = df.select(*[F.col(c).alias(c.replace("_", " ")) for c in df.columns])
    out.write.mode("append").option("header", "true").csv(path)


# Landing file-name patterns of the two feeds.
LANDING_GLOBS = {"raw_traffic": "raw_traffic*.csv", "raw_roads": "raw_roads*.csv"}


def landing_sources(cfg: LayerConfig, per_feed_folders: bool = False, glob: str | None = None) -> dict:
    """Where each feed's landing files are: ``{feed: (path, glob)}``.

    By default both feeds share the landing root and are told apart by file
    name (files may sit in sub-folders; the lookup is recursive).  With
    ``per_feed_folders`` each feed reads its own folder with ``glob``.
    """
    if per_feed_folders:
        return {feed: (cfg.landing(feed), glob or "*.csv") for feed in LANDING_GLOBS}
    return {feed: (cfg.landing(), pattern) for feed, pattern in LANDING_GLOBS.items()}


def start_bronze_streams(
    spark: SparkSession,
    cfg: LayerConfig,
    max_bytes_per_trigger: int | None = MAX_BYTES_PER_TRIGGER,
    sources: dict | None = None,
    on_error: str = "raise",
    counts_path: str | None = None,
):
    """Landing files -> validated bronze + quarantine (one query per feed, at once).

    A backlog is split into micro-batches of about ``max_bytes_per_trigger``,
    so one failed batch never means redoing the whole backlog.
    """
    sources = sources or landing_sources(cfg)
    feeds = (
        (traffic.TABLE, TRAFFIC_SUITE, TRAFFIC_SCHEMA, True),
        (roads.TABLE, ROADS_SUITE, ROADS_SCHEMA, False),
    )

    def start(table: str, suite: Suite, schema: StructType, stamped: bool):
        path, glob = sources[table]
        src = stream_csv(
            spark, path, schema, glob=glob, corrupt_column=CORRUPT, max_bytes_per_trigger=max_bytes_per_trigger
        )
        return start_validated_ingest(
            with_source_file(src),
            suite=suite,
            target_path=cfg.bronze(table),
            quarantine_path=cfg.quarantine(),
            checkpoint=cfg.checkpoint(f"bronze_{table}"),
            on_error=on_error,
            landing_schema=schema,
            stamped=stamped,
            counts_path=counts_path,
        )

    # A feed of which nothing has landed yet has no stream.
    landed = [feed for feed in feeds if path_exists(spark, sources[feed[0]][0])]
    return start_together(spark, {f"bronze_{feed[0]}": partial(start, *feed) for feed in landed})


def start_silver_streams(
    spark: SparkSession,
    cfg: LayerConfig,
    dedup: bool = True,
    dedup_horizon: str | None = None,
    max_bytes_per_trigger: int | None = MAX_BYTES_PER_TRIGGER,
):
    """bronze tables -> silver tables (stateful dedup, then column steps).

    By default the dedup state keeps a digest of every distinct record (exact,
    growing).  With ``dedup_horizon`` (e.g. ``"7 days"``) traffic dedup keeps a
    record only that long after its ingest time (``Extract_Time``), which
    bounds the state.  Batches are stamped when they are ingested, recovered
    rows when they are recovered, so rows newer than all before never come
    late; a repeat that arrives after the horizon passes through.
    """

    def start(module, name: str, src: str):
        stream = stream_table(spark, cfg.table(src), max_bytes_per_trigger=max_bytes_per_trigger)
        if dedup:
            bounded = dedup_horizon and EXTRACT_TIME in stream.columns
            stream = stream_dedup(
                stream,
                watermark_column=EXTRACT_TIME if bounded else None,
                watermark_delay=dedup_horizon or "1 hour",
            )
        return start_table_stream(
            CountedStreams.counted(module.silver_stream_step(stream), name),
            table=cfg.table(name),
            path=cfg.silver(name),
            checkpoint=cfg.checkpoint(f"{name}_load"),
        )

    layers = ((traffic, SILVER_TRAFFIC, traffic.TABLE), (roads, SILVER_ROADS, roads.TABLE))
    begun = [layer for layer in layers if layer_exists(spark, cfg.bronze(layer[2]))]  # the feed has a bronze batch
    return start_together(spark, {layer[1]: partial(start, *layer) for layer in begun})


def start_gold_streams(
    spark: SparkSession, cfg: LayerConfig, max_bytes_per_trigger: int | None = MAX_BYTES_PER_TRIGGER
):
    """silver tables -> gold tables (``refresh_gold_reports`` then defines the reports)."""

    def start(module, source: str, name: str):
        stream = stream_table(spark, cfg.table(source), fmt="parquet", max_bytes_per_trigger=max_bytes_per_trigger)
        return start_table_stream(
            CountedStreams.counted(module.gold(stream), name),
            table=cfg.table(name),
            path=cfg.gold(name),
            checkpoint=cfg.checkpoint(f"{name}_load"),
        )

    layers = ((traffic, SILVER_TRAFFIC, GOLD_TRAFFIC), (roads, SILVER_ROADS, GOLD_ROADS))
    begun = [layer for layer in layers if layer_exists(spark, cfg.silver(layer[1]))]
    return start_together(spark, {layer[2]: partial(start, *layer) for layer in begun})


def refresh_gold_reports(spark: SparkSession, cfg: LayerConfig) -> None:
    """Rebuild the regional summary from gold traffic (a batch overwrite:
    an aggregate over the whole table, like a materialized view)."""
    source = cfg.gold(GOLD_TRAFFIC)
    if layer_exists(spark, source):
        _write_summary(spark, cfg, gold_plan.region_summary(read_layer(spark, source, merge_schema=False)))
        create_traffic_roads_view(spark, cfg)


def _write_summary(spark: SparkSession, cfg: LayerConfig, summary: DataFrame) -> None:
    """A table of one row per (region, category)."""
    summary.write.mode("overwrite").parquet(cfg.gold(GOLD_REGION_SUMMARY))
    create_database(spark, cfg.database, f"{cfg.root}/catalog")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS `{cfg.database}`.`{GOLD_REGION_SUMMARY}` USING parquet "
        f"LOCATION '{cfg.gold(GOLD_REGION_SUMMARY)}'"
    )
    spark.catalog.refreshTable(cfg.table(GOLD_REGION_SUMMARY))


def run_streams(
    spark: SparkSession,
    cfg: LayerConfig,
    dedup: bool = True,
    dedup_horizon: str | None = None,
    sources: dict | None = None,
    on_error: str = "raise",
    count_rows: bool = False,
) -> None:
    """One available-now pass of every layer, each layer waited for in turn
    so a later layer never reads a half-written one.  The two feeds of a layer run
    at once; if one fails, the other is stopped and the failure rises.

    With ``count_rows`` the rows that every layer gained are counted by the writes
    and added to the table of counts (``cfg.report("layer_counts")``).
    """
    setup_tables(spark, cfg)
    path = cfg.report(LAYER_COUNTS)
    listener = CountedStreams()
    if count_rows:
        spark.streams.addListener(listener)
    try:
        run_together(start_bronze_streams(spark, cfg, sources=sources, on_error=on_error, counts_path=path if count_rows else None))
        run_together(start_silver_streams(spark, cfg, dedup=dedup, dedup_horizon=dedup_horizon))
        run_together(start_gold_streams(spark, cfg))
    finally:
        if count_rows:
            listener.record(spark, path)
            spark.streams.removeListener(listener)
    refresh_gold_reports(spark, cfg)
