"""SparkSession factory for the jobs, tests, the bench and local runs.

Settings that were submitted (spark-submit, ``--conf``, spark-defaults) or that
an active session already has always win; only what is unset is filled in.
"""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

# Read when the driver starts, so they go to the builder.
_AT_START = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}
# Settable later, so they are only set where the started application has none.
_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Stream dedup state can grow large; RocksDB keeps it off the JVM heap.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    # Checkpoint only the changes of each micro-batch, not whole state files.
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def _submitted(key: str) -> bool:
    """Was ``key`` given to a launcher that has started this process?"""
    return key in os.environ.get("PYSPARK_SUBMIT_ARGS", "") or "PYSPARK_GATEWAY_PORT" in os.environ


def get_session(
    master: str | None = None,
    app_name: str = "strata",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Return the active session, or start one with sane defaults."""
    spark = SparkSession.getActiveSession()
    if spark is None:
        spark = _start(master, app_name, extra or {})
        conf = spark.sparkContext.getConf()
        for key, value in _DEFAULTS.items():
            if not conf.contains(key):
                spark.conf.set(key, value)
        spark.sparkContext.setLogLevel("ERROR")
    if shuffle_partitions is not None:
        spark.conf.set("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return spark


def _start(master: str | None, app_name: str, extra: dict[str, str]) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    conf = {k: v for k, v in _AT_START.items() if not _submitted(k)}
    if master or not (os.environ.get("SPARK_MASTER") or _submitted("--master")):
        master = master or os.environ.get("STRATA_MASTER", "local[*]")
        builder = builder.master(master)
        if master.startswith("local") and not _submitted("driver-memory"):
            # Local mode runs every task in the driver JVM, whose default heap
            # (1 GiB) is far too small for 8 task threads and cached batches.
            # On a cluster spark-submit sets driver and executor memory.
            conf["spark.driver.memory"] = os.environ.get("STRATA_DRIVER_MEMORY", "16g")
    for key, value in {**conf, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
