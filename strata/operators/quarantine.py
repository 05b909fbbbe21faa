"""Validate-and-write of one batch, quarantine recovery and purge.

``validate_and_write`` is the body of the bronze ``foreachBatch`` sink and
of one-off batch loads.  Order of work per batch:

1. empty batch: return at once (one ``isEmpty`` probe);
2. table rules (column set) from the schema: a failure quarantines the whole
   batch with the table-level label, even if row rules fail too;
3. row rules as one projection; an error of the validation either raises or,
   with ``on_error="pass_through"``, lands the whole batch unvalidated;
4. quarantine rows first, then good rows; both writes replace only this
   batch's partition, and a side that has no rows (any more) is cleared, so a
   retry is exact, also with another suite.  With ``publish_to`` both are written
   aside and become visible together, through the catalog
   (``strata.sinks.publish``).

What was written is counted by the writes themselves (``BatchOutcome``), so no
monitor needs to read the layers again.

A batch label must belong to one writer: loads, streams and recoveries each
make labels of their own (see ``strata.labels``).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strata import labels
from strata.config import fresh_dir
from strata.operators.quality import (
    VIOLATIONS,
    annotate,
    quarantine_lines,
    quarantine_rows,
    quarantine_whole_batch,
    split,
)
from strata.operators.rules import Suite
from strata.schemas import BATCH_COLUMN, EXTRACT_TIME
from strata.sinks.publish import publish
from strata.sinks.tables import (
    delete_path,
    drop_partition,
    evolve_table,
    layer_exists,
    partition_path,
    path_exists,
    read_layer,
    write_batch,
    write_quarantine,
)

QUARANTINE_KEY = ("table_name", "gx_batch_id", "raw_data")


@dataclass(frozen=True)
class BatchOutcome:
    batch_id: str
    skipped: bool = False
    table_level: bool = False
    passed_through: bool = False
    n_good: int = 0
    n_quarantined: int = 0


def validate_and_write(
    df: DataFrame,
    batch_id,
    *,
    suite: Suite,
    target_path: str,
    quarantine_path: str,
    table_name: str | None = None,
    on_error: str = "raise",
    refused: DataFrame | None = None,
    target_table: str | None = None,
    publish_to: tuple[str, str] | None = None,
) -> BatchOutcome:
    """Validate one batch and write it to its target and the quarantine.

    ``refused`` are lines that never became rows (``label, raw``); they go to
    the quarantine with the batch.  With ``target_table`` the catalog table
    gains the columns that the batch has and it lacks.  ``publish_to`` names the
    catalog tables of the target and the quarantine; the paths are not used then.
    """
    if on_error not in ("raise", "pass_through"):
        raise ValueError("on_error must be 'raise' or 'pass_through'")
    spark, bid, name = df.sparkSession, str(batch_id), table_name or suite.table
    empty = df.isEmpty()
    lines = None if refused is None or refused.isEmpty() else quarantine_lines(refused, name, bid)
    if empty and lines is None:
        return BatchOutcome(bid, skipped=True)

    counts: dict[str, Observation] = {}

    def counted(rows: DataFrame | None, side: str) -> DataFrame | None:
        if rows is None:
            counts.pop(side, None)
            return None
        counts[side] = Observation(f"{side}_{uuid.uuid4().hex}")
        return rows.observe(counts[side], F.count(F.lit(1)).alias("n"))

    def write(bad: DataFrame | None, good: DataFrame | None) -> None:
        bad = counted(lines if bad is None else bad if lines is None else bad.unionByName(lines), "n_quarantined")
        good = counted(good, "n_good")
        bad_spec, good_spec = {"table_name": name, "gx_batch_id": bid}, {BATCH_COLUMN: bid}
        if publish_to is not None:
            if good is not None and target_table:
                evolve_table(spark, target_table, good.schema)
            target, quarantine = publish_to
            publish(spark, [(quarantine, bad_spec, bad), (target, good_spec, good)])
            return
        if bad is None:
            drop_partition(spark, quarantine_path, bad_spec)
        else:
            write_quarantine(bad, quarantine_path)
        if good is None:
            drop_partition(spark, target_path, good_spec)
        else:
            write_batch(good, target_path, bid)
            if target_table:
                evolve_table(spark, target_table, good.schema)

    def outcome(**how) -> BatchOutcome:
        return BatchOutcome(bid, **how, **{side: found.get["n"] for side, found in counts.items()})

    if empty:
        write(None, None)
        return outcome()
    if suite.table_failures(df.columns):
        write(quarantine_whole_batch(df, name, bid), None)
        return outcome(table_level=True)
    try:
        # Several jobs read the batch; keep it so the source is scanned once.
        # MEMORY_AND_DISK: a lost block is recomputed from the (replayable) source.
        annotated = annotate(df, suite).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            good, bad = split(annotated)
            write(
                None if bad.isEmpty() else quarantine_rows(annotated, name, bid), None if good.isEmpty() else good
            )
        finally:
            annotated.unpersist()
    except Exception:
        if on_error == "raise":
            raise
        write(None, df)  # a failing storage fails here again, and raises
        return outcome(passed_through=True)
    return outcome()


def select_quarantined(quarantine: DataFrame, table_name: str, rule: str | None = None) -> DataFrame:
    """Quarantine rows of one table, optionally only those that broke ``rule``
    (matched as one entry of the ``"; "`` list, not the whole text)."""
    cond = F.col("table_name") == table_name
    if rule is not None:
        cond = cond & F.array_contains(F.split(F.col("violated_rules"), "; "), rule)
    return quarantine.filter(cond)


def parse_quarantined(selected: DataFrame, schema: StructType, keep_key: bool = True) -> DataFrame:
    """``raw_data`` back into typed columns (fields absent in the JSON are
    NULL).  With ``keep_key`` the quarantine key rides along as ``_q_*``."""
    parsed = F.from_json(F.col("raw_data"), schema).alias("_row")
    keys = [F.col(k).alias(f"_q_{k}") for k in QUARANTINE_KEY] if keep_key else []
    return selected.select(*keys, parsed).select(*[f"_q_{k}" for k in QUARANTINE_KEY if keep_key], "_row.*")


@dataclass(frozen=True)
class Recovery:
    """``keys`` of the re-inserted rows that are still in the quarantine, and the
    bronze batches that hold them."""

    keys: DataFrame
    labels: tuple[str, ...]


def _raw_digest() -> Column:
    return F.unhex(F.sha2(F.coalesce("raw_data", F.lit("")), 256))


def _recovered(spark: SparkSession, log_path: str, table_name: str, target_path: str) -> DataFrame | None:
    """``(gx_batch_id, _digest, recovery)`` of the rows that finished recoveries brought
    back.  One that logged its rows but has no batch did not end: it is forgotten."""
    if not layer_exists(spark, log_path):
        return None
    log = read_layer(spark, log_path, merge_schema=False).where(F.col("table_name") == table_name)
    for (label,) in log.select("recovery").distinct().collect():  # one a recovery
        if not path_exists(spark, partition_path(spark, target_path, {BATCH_COLUMN: label})):
            drop_partition(spark, log_path, {"table_name": table_name, "recovery": label})
    if not layer_exists(spark, log_path):
        return None
    log = read_layer(spark, log_path, merge_schema=False).where(F.col("table_name") == table_name)
    return log.select("gx_batch_id", "_digest", "recovery")


def recover_batch(
    spark: SparkSession,
    *,
    quarantine_path: str,
    table_name: str,
    rule: str | None,
    schema: StructType,
    suite: Suite,
    target_path: str,
    batch_id: str | None = None,
    repair: Callable[[DataFrame], DataFrame] | None = None,
    quarantine_table: str | None = None,
) -> Recovery:
    """Re-ingest quarantined rows of one table (and rule).

    The rows are parsed, optionally repaired, revalidated with the table's
    suite, and the ones that now pass are written to the target as one batch.
    Its label comes from the recovered rows: the same recovery tried again
    replaces itself, any other gets a label of its own.  A label given by the
    caller must be new.  The ingest time becomes that of the recovery, so the
    rows count as new in the layers above, whose dedup may have a horizon.
    Rows that still fail stay in the quarantine untouched.

    Which rows were brought back is logged beside the quarantine, before they are
    written, so rows that were not purged are not brought back again.

    With ``quarantine_table`` the quarantine is read through the catalog
    (``spark.table``), otherwise by path.
    """
    quarantine = spark.table(quarantine_table) if quarantine_table else read_layer(spark, quarantine_path)
    selected = select_quarantined(quarantine, table_name, rule)
    log_path = f"{quarantine_path.rstrip('/')}_recovered"
    earlier = _recovered(spark, log_path, table_name, target_path)
    key_cols = [f"_q_{k}" for k in QUARANTINE_KEY]
    keys_path, labels_of = fresh_dir(spark, "recovered-keys"), []
    key_schema = quarantine.select(*QUARANTINE_KEY).schema
    if earlier is not None:
        known = selected.withColumn("_digest", _raw_digest())
        again = known.join(earlier, ["gx_batch_id", "_digest"]).select(*QUARANTINE_KEY, "recovery")
        again.dropDuplicates().write.parquet(f"{keys_path}/earlier")
        again = spark.read.schema(again.schema).parquet(f"{keys_path}/earlier")
        labels_of = [r[0] for r in again.select("recovery").distinct().collect()]
        # Left out by the written copy: a plan over the log itself would change when the log grows below.
        known_keys = again.select("gx_batch_id", _raw_digest().alias("_digest")).distinct()
        selected = known.join(known_keys, ["gx_batch_id", "_digest"], "left_anti").select(*quarantine.columns)
    rows = parse_quarantined(selected, schema)
    if repair is not None:
        rows = repair(rows)
    annotated = annotate(rows, suite).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        good, _ = split(annotated)
        good.select(*[F.col(f"_q_{k}").alias(k) for k in QUARANTINE_KEY]).write.parquet(f"{keys_path}/new")
        keys = spark.read.schema(key_schema).parquet(f"{keys_path}/new")
        label = labels.recovery(keys) if batch_id is None else batch_id
        if batch_id is not None and path_exists(spark, partition_path(spark, target_path, {BATCH_COLUMN: label})):
            raise ValueError(f"batch {label!r} exists already; a recovery needs a label of its own")
        if not keys.isEmpty():
            done = keys.select("table_name", "gx_batch_id", _raw_digest().alias("_digest"), F.lit(label).alias("recovery")).distinct()
            done.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("table_name", "recovery").parquet(log_path)
            good = good.drop(*key_cols)
            if EXTRACT_TIME in good.columns:
                good = good.withColumn(EXTRACT_TIME, F.current_timestamp())
            write_batch(good, target_path, label)
            labels_of.append(label)
    finally:
        annotated.unpersist()
    if earlier is not None:
        keys = keys.unionByName(again.select(*QUARANTINE_KEY))
    return Recovery(keys, tuple(sorted(set(labels_of))))


def recover_quarantine(spark: SparkSession, **how) -> DataFrame:
    """:func:`recover_batch`, giving the quarantine keys of the re-inserted rows
    (for ``purge``), read back from a written table."""
    return recover_batch(spark, **how).keys


def purge_quarantine(
    spark: SparkSession, quarantine_path: str, recovered_keys: DataFrame, quarantine_table: str | None = None
) -> None:
    """Remove re-inserted rows from the quarantine (parquet has no DELETE).

    Only the (table_name, gx_batch_id) partitions that hold recovered rows
    are rewritten: their remaining rows go to a staging table first, because a
    path must not be overwritten by a plan that reads it; partitions left
    empty are removed.  Rows are matched by a digest of their text, so the
    recovered texts are not shuffled.
    """
    quarantine = read_layer(spark, quarantine_path)
    parts = recovered_keys.select("table_name", "gx_batch_id").distinct()
    touched = quarantine.join(parts, on=["table_name", "gx_batch_id"], how="left_semi")
    digest = F.sha2(F.coalesce("raw_data", F.lit("")), 256)
    done = recovered_keys.select("table_name", "gx_batch_id", digest.alias("_digest")).distinct()
    remaining = touched.withColumn("_digest", digest).join(done, ["table_name", "gx_batch_id", "_digest"], "left_anti").drop("_digest")
    staging = fresh_dir(spark, "quarantine-staging")
    remaining.write.partitionBy("table_name", "gx_batch_id").parquet(staging)

    kept = read_layer(spark, staging) if layer_exists(spark, staging) else remaining.limit(0)
    emptied = parts.join(
        kept.select("table_name", "gx_batch_id").distinct(), ["table_name", "gx_batch_id"], "left_anti"
    )
    # A folder each, and as many as recovered batches; rows are never collected.
    for row in emptied.collect():
        drop_partition(spark, quarantine_path, {"table_name": row[0], "gx_batch_id": row[1]}, quarantine_table)
    write_quarantine(kept.select(*quarantine.columns), quarantine_path)
    if quarantine_table:
        spark.catalog.refreshTable(quarantine_table)


def _purged_path(quarantine_path: str) -> str:
    return f"{quarantine_path.rstrip('/')}_purged"


def mark_purged(spark: SparkSession, quarantine_path: str, recovered_keys: DataFrame) -> None:
    """Purge by tombstones: the digests of re-inserted rows are added to a table of
    their own, in one write; no quarantine partition is touched.  Readers use
    :func:`live_quarantine`.  The same keys marked again replace themselves."""
    rows = recovered_keys.select("table_name", "gx_batch_id", _raw_digest().alias("_digest")).distinct()
    write_batch(rows, _purged_path(quarantine_path), labels.recovery(rows), batch_column="purge")


def live_quarantine(spark: SparkSession, quarantine_path: str) -> DataFrame:
    """The quarantine without the rows that are marked as purged."""
    rows, purged = read_layer(spark, quarantine_path), _purged_path(quarantine_path)
    if not layer_exists(spark, purged):
        return rows
    marks = read_layer(spark, purged, merge_schema=False).select("table_name", "gx_batch_id", "_digest").distinct()
    return rows.withColumn("_digest", _raw_digest()).join(marks, ["table_name", "gx_batch_id", "_digest"], "left_anti").select(*rows.columns)


def compact_quarantine(spark: SparkSession, quarantine_path: str, quarantine_table: str | None = None) -> None:
    """Rewrite the partitions that hold purged rows without them, then forget the
    marks.  Until then the marks hold, so a killed compaction is simply run again."""
    purged = _purged_path(quarantine_path)
    if not layer_exists(spark, purged):
        return
    marks = read_layer(spark, purged, merge_schema=False).select("table_name", "gx_batch_id", "_digest").distinct()
    rows = read_layer(spark, quarantine_path).withColumn("_digest", _raw_digest())
    keys = rows.join(marks, ["table_name", "gx_batch_id", "_digest"], "left_semi").select(*QUARANTINE_KEY)
    staged = fresh_dir(spark, "purged-keys")
    keys.write.parquet(staged)
    purge_quarantine(spark, quarantine_path, spark.read.schema(keys.schema).parquet(staged), quarantine_table)
    delete_path(spark, purged)


__all__ = [
    "BatchOutcome",
    "QUARANTINE_KEY",
    "Recovery",
    "VIOLATIONS",
    "compact_quarantine",
    "live_quarantine",
    "mark_purged",
    "parse_quarantined",
    "purge_quarantine",
    "recover_batch",
    "recover_quarantine",
    "select_quarantined",
    "validate_and_write",
]
