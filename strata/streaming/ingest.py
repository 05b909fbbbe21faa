"""Bronze ingest stream: landing files -> validate -> bronze + quarantine.

The file source remembers processed files in the checkpoint, so every run
only reads new files; each micro-batch is validated and written by
``validate_and_write`` with a label of the checkpoint's id and the micro-batch
number, which makes a replayed batch overwrite its own output (exactly once)
and no other stream's, nor that of an earlier checkpoint.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from strata import labels
from strata.operators.monitor import record_counts
from strata.operators.quarantine import validate_and_write
from strata.operators.rules import Suite
from strata.sources.files import split_landing, with_extract_time


def start_validated_ingest(
    stream: DataFrame,
    *,
    suite: Suite,
    target_path: str,
    quarantine_path: str,
    checkpoint: str,
    table_name: str | None = None,
    on_error: str = "raise",
    query_name: str | None = None,
    landing_schema: StructType | None = None,
    stamped: bool = False,
    target_table: str | None = None,
    counts_path: str | None = None,
) -> StreamingQuery:
    """Start an available-now stream whose sink validates each micro-batch.

    With ``landing_schema`` the stream holds raw landing rows (see
    ``split_landing``): files with a wrong header and malformed lines are
    quarantined first.  ``stamped`` adds the ingest time.  With ``counts_path``
    what each batch wrote is added to the table of counts there.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        refused = None
        if landing_schema is not None:
            batch = batch.persist()
        try:
            rows = batch
            if landing_schema is not None:
                rows, refused = split_landing(batch, landing_schema)
            label = labels.stream(batch.sparkSession, checkpoint, batch_id)
            outcome = validate_and_write(
                with_extract_time(rows) if stamped else rows,
                label,
                suite=suite,
                target_path=target_path,
                quarantine_path=quarantine_path,
                table_name=table_name,
                on_error=on_error,
                refused=refused,
                target_table=target_table,
            )
            if counts_path is not None:
                table = table_name or suite.table
                record_counts(batch.sparkSession, counts_path, label, {table: outcome.n_good, f"{table}_quarantine": outcome.n_quarantined})
        finally:
            if landing_schema is not None:
                batch.unpersist()

    writer = stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    if query_name:
        writer = writer.queryName(query_name)
    return writer.trigger(availableNow=True).start()


@contextmanager
def in_pool(spark: SparkSession, pool: str) -> Iterator[None]:
    """Jobs and streams started here belong to a scheduler pool of their own, so
    under fair scheduling (``spark.scheduler.mode``) one feed cannot starve another."""
    before = spark.sparkContext.getLocalProperty("spark.scheduler.pool")
    spark.sparkContext.setLocalProperty("spark.scheduler.pool", pool)
    try:
        yield
    finally:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", before)


def start_together(spark: SparkSession, starts: Mapping[str, Callable[[], StreamingQuery]]) -> list[StreamingQuery]:
    """Start each stream in a pool of its name; if one does not start, those that
    did are stopped."""
    queries: list[StreamingQuery] = []
    try:
        for pool, start in starts.items():
            with in_pool(spark, pool):
                queries.append(start())
    except BaseException:
        stop_all(queries)
        raise
    return queries


def stop_all(queries: Sequence[StreamingQuery]) -> None:
    for query in queries:
        if query.isActive:
            query.stop()


def run_together(queries: Sequence[StreamingQuery], seconds: float = 0.2) -> None:
    """Wait for available-now streams that run at the same time.  The first that
    fails stops the others, whose next run resumes from their checkpoints, and
    its failure rises."""
    waiting = list(queries)
    try:
        while waiting:
            waiting = [query for query in waiting if not query.awaitTermination(seconds)]
        for query in queries:
            run_available_now(query)
    except BaseException:
        stop_all(queries)
        raise


def run_available_now(query: StreamingQuery) -> StreamingQuery:
    """Wait until an available-now query has drained its input; re-raise
    its failure if it stopped with one."""
    query.awaitTermination()
    exc = query.exception()
    if exc is not None:
        raise RuntimeError(f"stream {query.name or query.id} failed: {exc}")
    return query
