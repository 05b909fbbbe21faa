"""Table sources: catalog tables as streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# A first run or a backlog is split into micro-batches of about this much data.
MAX_BYTES_PER_TRIGGER = 64 << 30


def stream_table(
    spark: SparkSession, name: str, fmt: str | None = None, max_bytes_per_trigger: int | None = MAX_BYTES_PER_TRIGGER
) -> DataFrame:
    """``readStream.table``: new files of a layer table become new rows."""
    reader = spark.readStream
    if fmt:
        reader = reader.format(fmt)
    if max_bytes_per_trigger:
        reader = reader.option("maxBytesPerTrigger", str(max_bytes_per_trigger))
    return reader.table(name)
