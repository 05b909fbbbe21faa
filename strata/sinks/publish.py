"""Batches that become visible as a whole, through the catalog.

The outputs of a batch are first all written to folders of their own, which no
table names.  Only then do the tables' partitions point to them: metadata
changes that read and write no data.  A batch whose second output fails shows in
no table, and a replaced batch is complete, old or new, at any time.  Readers
must go through the catalog; folders of replaced batches stay until
:func:`remove_unpublished`.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from strata.sinks.tables import delete_path, list_folders


def _spec(spec: Mapping[str, str]) -> str:
    quoted = {k: v.replace("\\", "\\\\").replace("'", "\\'") for k, v in spec.items()}
    return ", ".join(f"`{k}` = '{v}'" for k, v in quoted.items())


def table_location(spark: SparkSession, table: str) -> str:
    details = spark.sql(f"DESCRIBE TABLE EXTENDED {table}")
    return details.where("col_name = 'Location'").first()["data_type"].rstrip("/")


def _versions(spark: SparkSession, table: str) -> str:
    return f"{table_location(spark, table)}/_versions"


def publish(spark: SparkSession, outputs: Sequence[tuple[str, Mapping[str, str], DataFrame | None]]) -> None:
    """Make each (table, partition, rows) of a batch visible; None removes the partition."""
    staged = []
    for table, spec, rows in outputs:
        path = None
        if rows is not None:
            path = f"{_versions(spark, table)}/{uuid.uuid4().hex}"
            rows.drop(*spec).write.parquet(path)
        staged.append((table, _spec(spec), path))
    for table, spec, path in staged:
        if path is None:
            spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({spec})")
        else:
            spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS PARTITION ({spec}) LOCATION '{path}'")
            spark.sql(f"ALTER TABLE {table} PARTITION ({spec}) SET LOCATION '{path}'")
        spark.catalog.refreshTable(table)


def published(spark: SparkSession, table: str) -> set[str]:
    """The folders that the table's partitions point to (one name a batch)."""
    db, _, name = table.rpartition(".")
    catalog = spark._jsparkSession.sessionState().catalog()
    jvm = spark.sparkContext._jvm
    ident = jvm.org.apache.spark.sql.catalyst.TableIdentifier(name, jvm.scala.Option.apply(db or None))
    parts = catalog.listPartitions(ident, jvm.scala.Option.empty()).iterator()
    found = set()
    while parts.hasNext():
        found.add(parts.next().location().getPath().rstrip("/").rsplit("/", 1)[-1])
    return found


def remove_unpublished(spark: SparkSession, table: str) -> int:
    """Delete the folders of failed and replaced batches; no load may be running
    and no reader may still use them.  How many were deleted."""
    live, n = published(spark, table), 0
    for path in list_folders(spark, _versions(spark, table)):
        if path.rstrip("/").rsplit("/", 1)[-1] not in live:
            delete_path(spark, path)
            n += 1
    return n
