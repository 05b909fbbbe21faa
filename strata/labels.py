"""Labels of bronze batches, one name space for each kind of writer.

Writing a batch replaces the partition of its label, which makes retries exact
and makes a label that two writers share lose rows.  So a load's labels start
with ``load-``, a stream's with ``stream-`` and the id of its checkpoint (a new
checkpoint is a new stream), a recovery's with ``recovery-`` and a digest of
the rows it brings back.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def load(batch_id: str | None = None) -> str:
    """The label of a batch load: the caller's id, else a new one."""
    return f"load-{batch_id if batch_id is not None else uuid.uuid4().hex[:12]}"


def stream(spark: SparkSession, checkpoint: str, batch_id: int) -> str:
    """The label of a micro-batch of the stream with this checkpoint."""
    query = json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]
    return f"stream-{query.replace('-', '')[:16]}-{batch_id}"


def recovery(keys: DataFrame) -> str:
    """The label of a recovery: the same for the same quarantined rows, in any order."""
    rows = keys.select(F.xxhash64(*keys.columns).alias("a"), F.xxhash64(F.lit(1), *keys.columns).alias("b"))
    wide = lambda c: F.sum(F.col(c).cast("decimal(38,0)"))
    n, a, b = rows.agg(F.count("*"), wide("a"), wide("b")).first()
    return f"recovery-{uuid.uuid5(uuid.NAMESPACE_OID, f'{n} {a} {b}').hex[:16]}"
