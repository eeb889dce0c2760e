"""Session helpers.

The engine is UTC-pinned: every time column is a ``TIMESTAMP_NTZ`` holding the UTC wall-clock
time, so results never depend on the cluster's default zone. Text parsing goes through the
session zone, which is therefore set to UTC by :func:`ensure_utc`.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # streaming state (K5 running pair counts, K3 de-dup keys) lives off-heap in RocksDB
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8, app: str = "staffrank",
                  extra: dict | None = None) -> SparkSession:
    """Local session for tests and benchmarks (clusters bring their own session)."""
    builder = (SparkSession.builder.master(master).appName(app)
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", os.environ.get("STAFFRANK_DRIVER_MEMORY", "16g")))
    for k, v in {**SESSION_DEFAULTS, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_utc(spark: SparkSession) -> None:
    if spark.conf.get("spark.sql.session.timeZone", None) != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def by_shift(spark: SparkSession) -> None:
    """Rows that lie together by ``shift_id`` are not shuffled again for a join by shift and user."""
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names in ``spark.checkpoint.dir``.

    Only when the setting is absent (local tests) a scratch folder is created and registered.
    """
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir", None)
    if conf_dir:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(conf_dir)
        return conf_dir
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    local = tempfile.mkdtemp(prefix="staffrank-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    spark.conf.set("spark.checkpoint.dir", local)
    spark.sparkContext.setCheckpointDir(local)
    return local


def shared_dir(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint location for materialised intermediate tables."""
    base = ensure_checkpoint_dir(spark)
    return base.rstrip("/") + "/" + name
