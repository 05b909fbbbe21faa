"""Table sinks: idempotent per-batch writes, schema evolution, DDL."""

from strata.sinks.tables import (
    create_database,
    create_table,
    drop_partition,
    evolve_table,
    read_layer,
    write_batch,
    write_quarantine,
)

__all__ = [
    "create_database",
    "create_table",
    "drop_partition",
    "evolve_table",
    "read_layer",
    "write_batch",
    "write_quarantine",
]
