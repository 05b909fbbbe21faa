"""Table-to-table streams (bronze -> silver -> gold) and stream dedup.

A layer stream reads a table incrementally (``readStream.table``), applies
stateless column steps, optionally a stateful dedup, and appends to the
next table through the file sink, whose metadata log commits each
micro-batch atomically: readers only see complete batches, and a restart
resumes from the checkpoint without duplicating output.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from strata.operators.clean import payload_columns, payload_digest
from strata.schemas import AUDIT_COLUMNS

_KEY = "_payload_key"


def stream_dedup(
    stream: DataFrame,
    columns: Sequence[str] | None = None,
    watermark_column: str | None = None,
    watermark_delay: str = "1 hour",
) -> DataFrame:
    """Drop repeated records across micro-batches and restarts.

    Without a watermark the state keeps the digest of every distinct record
    (exact; 32 bytes each, growing); with ``watermark_column`` the
    within-watermark form bounds the state and may let a repeat through that
    arrives later than the delay.  All deliveries of one record reach one state
    partition: streaming dedup has no map-side step.
    """
    cols = list(columns) if columns else payload_columns(stream, AUDIT_COLUMNS)
    keyed = stream.withColumn(_KEY, payload_digest(stream, cols))
    if watermark_column:
        return keyed.withWatermark(watermark_column, watermark_delay).dropDuplicatesWithinWatermark([_KEY]).drop(_KEY)
    return keyed.dropDuplicates([_KEY]).drop(_KEY)


def start_table_stream(
    stream: DataFrame,
    *,
    table: str,
    path: str,
    checkpoint: str,
    fmt: str = "parquet",
    query_name: str | None = None,
) -> StreamingQuery:
    """Append a stream to a catalog table stored at ``path`` (available-now)."""
    writer = (
        stream.writeStream.format(fmt)
        .option("checkpointLocation", checkpoint)
        .option("path", path)
        .outputMode("append")
        .trigger(availableNow=True)
    )
    if query_name:
        writer = writer.queryName(query_name)
    return writer.toTable(table)
