"""Which batches delivered a record: an index of digests over all batches.

A table layer keeps each record once, in the partition of the batch that owns
it.  The index has one row for each different record of each batch, bucketed by
the record's digest and partitioned by batch, and says whether the batch owns
it.  A new batch is shuffled into the index's buckets and met there: the history
is read bucket by bucket, never shuffled.

When a batch is replaced, records that it owned and no longer delivers go to
another batch that delivers them, if there is one.

Rule: the loads of one table run one after the other.  A load that finds another
one's claim raises (see :meth:`DeliveryIndex.claim`).
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.config import fresh_dir
from strata.schemas import BATCH_COLUMN
from strata.sinks.tables import create_file, delete_path, path_exists

KEY = "_payload_key"


def _quoted(label: str) -> str:
    return "'" + label.replace("\\", "\\\\").replace("'", "\\'") + "'"


@dataclass(frozen=True)
class DeliveryIndex:
    table: str
    path: str
    buckets: int

    @classmethod
    def open(cls, spark: SparkSession, table: str, path: str) -> DeliveryIndex:
        """The index at ``path`` as a catalog table; a session that does not know the
        table finds it in its folder.

        The number of buckets is that of the session's shuffle partitions at the
        first load, and stays: choose them for the digests (33 bytes each) of
        the whole history to come.
        """
        create_file(spark, f"{path}.buckets", spark.conf.get("spark.sql.shuffle.partitions"))
        buckets = int(spark.read.text(f"{path}.buckets").first()[0])
        if not spark.catalog.tableExists(table):
            spark.sql(
                f"CREATE TABLE IF NOT EXISTS {table} ({KEY} BINARY, owner BOOLEAN, {BATCH_COLUMN} STRING) USING parquet "
                f"PARTITIONED BY ({BATCH_COLUMN}) CLUSTERED BY ({KEY}) INTO {buckets} BUCKETS LOCATION '{path}'"
            )
            if path_exists(spark, path):
                spark.sql(f"ALTER TABLE {table} RECOVER PARTITIONS")
        return cls(table, path, buckets)

    @contextmanager
    def claim(self, spark: SparkSession, label: str) -> Iterator[None]:
        """Only one load at a time: a second one would take the same records for
        new.  A claim that a lost driver left is its own label's to take over."""
        claim = f"{self.path}.claim"
        if not create_file(spark, claim, label):
            held = spark.read.text(claim).first()
            if held is None or held[0] != label:
                raise RuntimeError(f"batch {held and held[0]!r} is being loaded into {self.table}; load {label!r} after it (or remove {claim})")
        try:
            yield
        finally:
            delete_path(spark, claim)

    def rows(self, spark: SparkSession) -> DataFrame:
        return spark.table(self.table)

    def owned(self, spark: SparkSession, label: str) -> DataFrame:
        """Digests of the records that a batch owns."""
        return self.rows(spark).where((F.col(BATCH_COLUMN) == label) & F.col("owner")).select(KEY)

    def flagged(self, keys: DataFrame, label: str) -> DataFrame:
        """The batch's digests (each once), and whether it owns them: no other does."""
        others = self.rows(keys.sparkSession).where((F.col(BATCH_COLUMN) != label) & F.col("owner"))
        taken = others.select(KEY, F.lit(True).alias("_taken"))
        dealt = keys.repartition(self.buckets, KEY)
        return dealt.join(taken, KEY, "left").select(KEY, F.col("_taken").isNull().alias("owner"))

    def heirs(self, keys: DataFrame, label: str) -> DataFrame:
        """``(digest, batch)``: who takes over what the batch owns but has not in ``keys``."""
        spark = keys.sparkSession
        gone = self.owned(spark, label).join(keys, KEY, "left_anti").repartition(self.buckets, KEY)
        others = self.rows(spark).where(F.col(BATCH_COLUMN) != label)
        # One that took over before (in a load that did not end) comes first.
        first = F.min(F.struct(~F.col("owner"), F.col(BATCH_COLUMN)))
        return gone.join(others, KEY).groupBy(KEY).agg(first.alias("_first")).select(KEY, F.col(f"_first.{BATCH_COLUMN}").alias(BATCH_COLUMN))

    def write(self, rows: DataFrame, label: str) -> None:
        """``rows`` (digest, owner) become the batch's partition."""
        spark = rows.sparkSession
        staged = fresh_dir(spark, "deliveries")
        rows.select(KEY, "owner").write.parquet(staged)  # it may be read from this table
        view = f"deliveries_{uuid.uuid4().hex}"
        spark.read.schema(rows.select(KEY, "owner").schema).parquet(staged).repartition(self.buckets, KEY).createOrReplaceTempView(view)
        try:
            spark.sql(f"INSERT OVERWRITE TABLE {self.table} PARTITION ({BATCH_COLUMN} = {_quoted(label)}) SELECT {KEY}, owner FROM {view}")
        finally:
            spark.catalog.dropTempView(view)

    def pass_on(self, keys: DataFrame, label: str) -> list[str]:
        """Other batches take over what ``label`` no longer delivers; their labels."""
        spark = keys.sparkSession
        staged = fresh_dir(spark, "heirs")
        self.heirs(keys, label).write.parquet(staged)
        heirs = spark.read.schema(f"{KEY} binary, {BATCH_COLUMN} string").parquet(staged)
        labels = [r[0] for r in heirs.select(BATCH_COLUMN).distinct().collect()]  # of batches, as many as partitions
        for other in labels:
            moved = heirs.where(F.col(BATCH_COLUMN) == other).select(KEY, F.lit(True).alias("_moved")).repartition(self.buckets, KEY)
            rows = self.rows(spark).where(F.col(BATCH_COLUMN) == other).join(moved, KEY, "left")
            self.write(rows.select(KEY, (F.col("owner") | F.col("_moved").isNotNull()).alias("owner")), other)
        return sorted(labels)
