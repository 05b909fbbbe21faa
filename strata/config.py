"""Environment configuration: where each layer lives.

One frozen dataclass carries the environment, the storage root and the
database, and every path is derived from it.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from dataclasses import dataclass

from pyspark.sql import SparkSession

_ENVIRONMENTS = ("dev", "uat", "prod")


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """A folder on the storage every executor shares.

    Read from ``spark.checkpoint.dir`` (set by the cluster), then from the
    SparkContext checkpoint dir.  Only a local session (one machine) may have
    neither: it gets a private temporary folder, registered as the checkpoint
    dir.  On a cluster that is an error, since other machines cannot see it.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError(f"set spark.checkpoint.dir to a folder that all machines of {master} share")
        root = tempfile.mkdtemp(prefix="strata-")
        spark.sparkContext.setCheckpointDir(root)
    root = root.rstrip("/")
    return "/".join([root, *parts]) if parts else root


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A new, never-used folder under the shared root for one job run."""
    return shared_dir(spark, "strata", f"{label}-{uuid.uuid4().hex[:12]}")


@dataclass(frozen=True)
class LayerConfig:
    """Paths and names of one environment of the layered tables.

    ``root`` must be on shared storage (HDFS, object store, NFS); landing,
    bronze, silver, gold, quarantine and checkpoints hang below it.
    """

    root: str
    environment: str = "dev"
    database: str = "traffic_db"
    quarantine_table: str = "data_quality_quarantine"

    def __post_init__(self) -> None:
        if self.environment not in _ENVIRONMENTS:
            raise ValueError(f"environment must be one of {_ENVIRONMENTS}")

    @classmethod
    def scratch(cls, spark: SparkSession, label: str = "run", environment: str = "dev") -> "LayerConfig":
        """A configuration in a fresh folder under the shared root."""
        run = fresh_dir(spark, label)
        # Catalog identifiers: letters, digits and underscores only.
        database = re.sub(r"[^0-9A-Za-z_]", "_", f"{label}_{run.rsplit('-', 1)[-1]}")
        return cls(root=run, environment=environment, database=database)

    def landing(self, feed: str = "") -> str:
        return f"{self.root}/landing/{feed}".rstrip("/")

    def bronze(self, table: str) -> str:
        return f"{self.root}/medallion/bronze/{table}"

    def silver(self, table: str) -> str:
        return f"{self.root}/medallion/silver/{table}"

    def gold(self, table: str) -> str:
        return f"{self.root}/medallion/gold/{table}"

    def silver_keys(self, table: str) -> str:
        return f"{self.root}/medallion/silver_keys/{table}"

    def report(self, name: str) -> str:
        return f"{self.root}/quality/{name}"

    def quarantine(self) -> str:
        return f"{self.root}/quality/{self.quarantine_table}"

    def checkpoint(self, stream: str) -> str:
        return f"{self.root}/checkpoints/{stream}"

    def table(self, name: str) -> str:
        return f"{self.database}.{name}"
