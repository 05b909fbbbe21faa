"""Monitoring: row counts per layer, reconciliation, quality rates.

All counts of all layers are one DataFrame (a union of global aggregates),
so the monitor is one Spark job, not one query per table.
"""

from __future__ import annotations

import threading
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener


def layer_counts(layers: Mapping[str, DataFrame]) -> DataFrame:
    """``layer, n_rows`` for every named DataFrame."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("layer"), "n_rows")
        for name, df in layers.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def sql_layer_counts(spark: SparkSession, tables: Mapping[str, str]) -> DataFrame:
    """``layer, n_rows`` through SQL: one ``UNION ALL`` statement counting
    every named table or view, planned and run as a single job."""
    parts = [f"SELECT '{layer}' AS layer, COUNT(*) AS n_rows FROM {name}" for layer, name in tables.items()]
    if not parts:
        return spark.createDataFrame([], "layer string, n_rows bigint")
    return spark.sql(" UNION ALL ".join(parts))


COUNTS_SCHEMA = "n_rows long, layer string, batch string"


def record_counts(spark: SparkSession, path: str, batch: str, counts: Mapping[str, int]) -> None:
    """Add what a batch wrote to each layer to the table of counts; a repeated
    batch replaces its own."""
    rows = spark.createDataFrame([(n, layer, batch) for layer, n in counts.items()], COUNTS_SCHEMA).coalesce(1)
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("layer", "batch").parquet(path)


def recorded_counts(spark: SparkSession, path: str) -> DataFrame:
    """``layer, n_rows`` from the table of counts: no layer is read."""
    rows = spark.read.schema(COUNTS_SCHEMA).parquet(path)
    return rows.groupBy("layer").agg(F.sum("n_rows").alias("n_rows"))


class CountedStreams(StreamingQueryListener):
    """Counts the rows of streams as they write them.

    ``counted`` adds the measure to a stream; the listener keeps what each micro-batch
    reports, and ``record`` (after the run) adds it to the table of counts.  A batch
    whose report was lost with its driver is missing there; ``layer_counts`` tells.
    """

    def __init__(self) -> None:
        self._seen: dict[tuple[str, str], int] = {}
        self._lock = threading.Lock()

    @staticmethod
    def counted(stream: DataFrame, layer: str) -> DataFrame:
        return stream.observe(f"rows_of_{layer}", F.count(F.lit(1)).alias("n"))

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        for name, row in progress.observedMetrics.items():
            if name.startswith("rows_of_"):
                with self._lock:
                    self._seen[name.removeprefix("rows_of_"), f"{progress.id}-{progress.batchId}"] = row.n

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def record(self, spark: SparkSession, path: str) -> None:
        """Write the counts seen so far (once the listener bus has told them all)."""
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
        with self._lock:
            seen, self._seen = self._seen, {}
        by_batch: dict[str, dict[str, int]] = {}
        for (layer, batch), n in seen.items():
            by_batch.setdefault(batch, {})[layer] = n
        for batch, counts in by_batch.items():
            record_counts(spark, path, batch, counts)


def reconcile(counts: DataFrame, checks: Mapping[str, tuple[list[str], list[str]]]) -> DataFrame:
    """Equality checks between sums of layer counts.

    ``checks`` maps a check name to (left layers, right layers); the output
    is ``check, lhs, rhs, ok``.  The counts are pivoted into one row first
    (tiny), then every check is a column expression.
    """
    layers = sorted({name for lhs, rhs in checks.values() for name in lhs + rhs})
    wide = counts.agg(
        *[F.sum(F.when(F.col("layer") == name, F.col("n_rows")).otherwise(0)).alias(name) for name in layers]
    )
    rows = []
    for check, (lhs, rhs) in checks.items():
        left = reduce(lambda a, b: a + b, [F.col(n) for n in lhs])
        right = reduce(lambda a, b: a + b, [F.col(n) for n in rhs])
        rows.append(
            F.struct(
                F.lit(check).alias("check"),
                left.cast("long").alias("lhs"),
                right.cast("long").alias("rhs"),
                (left == right).alias("ok"),
            )
        )
    return wide.select(F.explode(F.array(*rows)).alias("c")).select("c.*")


def quality_rate(summary: DataFrame) -> DataFrame:
    """From ``table_name, n_input, n_good, n_quarantined``: pass rate per table."""
    return summary.select(
        "table_name",
        "n_input",
        "n_quarantined",
        F.round(F.try_divide(F.col("n_good").cast("double"), F.col("n_input").cast("double")), 6).alias(
            "pass_rate"
        ),
    )


def table_quality(batches: DataFrame) -> DataFrame:
    """``batch_quality`` rolled up to one row per table."""
    sums = batches.groupBy("table_name").agg(
        F.count(F.lit(1)).alias("n_batches"), *[F.sum(c).alias(c) for c in ("n_input", "n_good", "n_quarantined")]
    )
    rate = F.round(F.try_divide(F.col("n_good").cast("double"), F.col("n_input").cast("double")), 6)
    return sums.withColumn("pass_rate", rate)


def batch_quality(targets: Mapping[str, DataFrame], quarantine: DataFrame, batch_column: str = "_batch_id") -> DataFrame:
    """Pass rate per (table, batch) from the written layers.

    ``targets`` maps a table name to its bronze table (partitioned by batch);
    good rows are counted per batch partition, quarantined rows per
    (table_name, gx_batch_id) partition -- both counts come from parquet
    metadata, no row is decoded.  Output: ``table_name, batch_id, n_input,
    n_good, n_quarantined, pass_rate``.
    """
    good = reduce(
        DataFrame.unionByName,
        [
            df.groupBy(F.col(batch_column).cast("string").alias("batch_id"))
            .agg(F.count(F.lit(1)).alias("n_good"))
            .withColumn("table_name", F.lit(name))
            for name, df in targets.items()
        ],
    )
    bad = quarantine.groupBy("table_name", F.col("gx_batch_id").cast("string").alias("batch_id")).agg(
        F.count(F.lit(1)).alias("n_quarantined")
    )
    both = good.join(bad, ["table_name", "batch_id"], "full_outer").select(
        "table_name",
        "batch_id",
        F.coalesce("n_good", F.lit(0)).alias("n_good"),
        F.coalesce("n_quarantined", F.lit(0)).alias("n_quarantined"),
    )
    n_input = F.col("n_good") + F.col("n_quarantined")
    return both.select(
        "table_name",
        "batch_id",
        n_input.alias("n_input"),
        "n_good",
        "n_quarantined",
        F.round(F.try_divide(F.col("n_good").cast("double"), n_input.cast("double")), 6).alias("pass_rate"),
    )
