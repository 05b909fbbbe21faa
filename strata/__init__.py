"""strata: layered (bronze / silver / gold) data pipelines on Spark.

Every operator is a plain ``DataFrame -> DataFrame`` function built from
``pyspark.sql.functions``; the same functions serve batch jobs and
Structured Streaming micro-batches.  No Python UDF sits on a row path.
"""

from strata.config import LayerConfig, shared_dir
from strata.operators.clean import dedup_by_key, dedup_full_row, null_policy
from strata.operators.quality import annotate, quarantine_rows, split
from strata.operators.quarantine import purge_quarantine, recover_quarantine, validate_and_write
from strata.operators.rules import (
    Between,
    ColumnSet,
    MatchesStrftime,
    NotNull,
    Suite,
    suite_from_spec,
    suite_to_spec,
)
from strata.session import get_session

__all__ = [
    "Between",
    "ColumnSet",
    "LayerConfig",
    "MatchesStrftime",
    "NotNull",
    "Suite",
    "annotate",
    "dedup_by_key",
    "dedup_full_row",
    "get_session",
    "null_policy",
    "purge_quarantine",
    "quarantine_rows",
    "recover_quarantine",
    "shared_dir",
    "split",
    "suite_from_spec",
    "suite_to_spec",
    "validate_and_write",
]
