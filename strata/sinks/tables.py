"""Layer tables on shared storage.

Every micro-batch is written into its own partition directory with dynamic
partition overwrite, so re-running a batch (executor loss, driver restart,
stream replay) replaces that batch instead of appending it twice.  Files of
different batches may carry different schemas; readers merge them.
"""

from __future__ import annotations

import threading
from collections.abc import Iterator, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strata.schemas import BATCH_COLUMN, ddl


def write_batch(
    df: DataFrame,
    path: str,
    batch_id,
    batch_column: str = BATCH_COLUMN,
    fmt: str = "parquet",
) -> None:
    """Write ``df`` as batch ``batch_id`` of the table at ``path`` (retry-safe)."""
    (
        df.withColumn(batch_column, F.lit(str(batch_id)))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(batch_column)
        .format(fmt)
        .save(path)
    )


def write_quarantine(df: DataFrame, path: str) -> None:
    """Quarantine rows, partitioned by (table_name, gx_batch_id); a retried
    batch replaces its own partition only.

    Bad rows are a small share of a batch but come from every task; the
    ``rebalance`` hint shuffles just those rows so AQE writes a few files of
    a sensible size instead of one tiny file per input task.
    """
    (
        df.hint("rebalance")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("table_name", "gx_batch_id")
        .parquet(path)
    )


_INFER = "spark.sql.sources.partitionColumnTypeInference.enabled"
_READ_LOCK = threading.Lock()


def read_layer(spark: SparkSession, path: str, merge_schema: bool = True) -> DataFrame:
    """Batch read of a layer table by path, merging evolved schemas.

    Partition values are batch labels: they are read as the strings they were
    written as (type inference would turn ``007`` into 7).
    """
    with _READ_LOCK:  # the setting is the session's, and layers are read from several threads
        before = spark.conf.get(_INFER)
        spark.conf.set(_INFER, "false")
        try:
            return spark.read.option("mergeSchema", str(merge_schema).lower()).parquet(path)
        finally:
            spark.conf.set(_INFER, before)


def _located(spark: SparkSession, path: str):
    """(file system, path) on any Hadoop-compatible storage."""
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hpath


def path_exists(spark: SparkSession, path: str) -> bool:
    """Does a file or folder exist?  One call, not a listing; errors rise."""
    fs, hpath = _located(spark, path)
    return bool(fs.exists(hpath))


def create_file(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small new file; False if there is one already."""
    fs, hpath = _located(spark, path)
    if fs.exists(hpath):
        return False
    fs.mkdirs(hpath.getParent())
    try:
        out = fs.create(hpath, False)
    except Exception:
        if fs.exists(hpath):  # another was faster
            return False
        raise
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    return True


def delete_path(spark: SparkSession, path: str) -> None:
    fs, hpath = _located(spark, path)
    fs.delete(hpath, True)


def list_files(spark: SparkSession, path: str) -> Iterator[str]:
    """All files below a folder."""
    fs, hpath = _located(spark, path)
    files = fs.listFiles(hpath, True)
    while files.hasNext():
        yield files.next().getPath().toString()


def list_folders(spark: SparkSession, path: str) -> list[str]:
    """The folders directly below a folder; none if it is not there."""
    fs, hpath = _located(spark, path)
    if not fs.exists(hpath):
        return []
    return [x.getPath().toString() for x in fs.listStatus(hpath) if x.isDirectory()]


def partition_values(spark: SparkSession, table_path: str, column: str) -> list[str]:
    """The values of a table's first partition column, from its folders."""
    unescape = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName
    names = (path.rstrip("/").rsplit("/", 1)[-1] for path in list_folders(spark, table_path))
    return [unescape(name[len(column) + 1 :]) for name in names if name.startswith(f"{column}=")]


def read_partition(spark: SparkSession, table_path: str, spec: Mapping[str, str]) -> DataFrame | None:
    """One partition's rows without its partition columns; None if it holds no
    file.  The rest of the table is neither listed nor read."""
    path = partition_path(spark, table_path, spec)
    return spark.read.parquet(path) if layer_exists(spark, path) else None


def layer_exists(spark: SparkSession, path: str) -> bool:
    """Has anything been written to a layer?

    Walks the folder until the first data file.  Only a missing folder or one
    without data files is "no": a failing storage or a broken file is an error
    of whoever reads the layer, never a layer that is silently left out.
    """
    fs, hpath = _located(spark, path)
    if not fs.exists(hpath):
        return False
    root = len(fs.makeQualified(hpath).toString())
    for name in list_files(spark, path):
        parts = name[root:].strip("/").split("/")
        # Folders such as _temporary hold no data; _batch_id=... is a partition.
        if not any(p.startswith(".") or (p.startswith("_") and "=" not in p) for p in parts):
            return True
    return False


def partition_path(spark: SparkSession, table_path: str, spec: Mapping[str, str]) -> str:
    """The folder of one partition, with its values escaped as Spark does."""
    escape = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    return "/".join([table_path.rstrip("/"), *(f"{k}={escape(v)}" for k, v in spec.items())])


def drop_partition(spark: SparkSession, table_path: str, spec: Mapping[str, str], table: str | None = None) -> None:
    """Remove one partition of a table stored at ``table_path`` (no error if
    there is none), and from the catalog if ``table`` names it there."""
    if table:
        part = ", ".join(f"{k} = '{v.replace(chr(39), chr(39) * 2)}'" for k, v in spec.items())
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({part})")
    delete_path(spark, partition_path(spark, table_path, spec))


def evolve_table(spark: SparkSession, table: str, schema: StructType) -> list[str]:
    """Add the columns of ``schema`` that a catalog table lacks; returns them.

    Older files have no such column and read as NULL; a stream that reads the
    table sees the new columns from its next start.
    """
    known = {c.lower() for c in spark.table(table).columns}
    new = StructType([f for f in schema.fields if f.name.lower() not in known])
    if new.fields:
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({ddl(new)})")
    return new.fieldNames()


def create_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`{loc}")


def create_table(
    spark: SparkSession,
    name: str,
    schema: StructType,
    location: str,
    partitioned_by: Sequence[str] = (),
    varchar: int | None = None,
    comment: str | None = None,
    column_comments: Mapping[str, str] | None = None,
) -> None:
    """``CREATE TABLE IF NOT EXISTS ... USING parquet LOCATION``.

    With ``varchar`` set, string columns are declared ``VARCHAR(n)``.  Batches
    are written by path, so the length is enforced by row rules
    (``Suite.with_lengths``).  Never drops an existing table.
    """
    parts = f" PARTITIONED BY ({', '.join(f'`{c}`' for c in partitioned_by)})" if partitioned_by else ""
    note = f" COMMENT '{comment}'" if comment else ""
    db, _, table = name.rpartition(".")
    qualified = f"`{db}`.`{table}`" if db else f"`{table}`"
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {qualified} ({ddl(schema, varchar, column_comments)}) USING parquet{parts}"
        f" LOCATION '{location}'{note}"
    )
