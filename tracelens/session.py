"""Spark session helpers.

The library never creates a session behind the caller's back; these helpers
are for tests, the benchmark and command-line use.  On a cluster the caller
passes its own session and the cluster's ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # merge small shuffle partitions up to the advisory size instead of
    # keeping one per core (Spark's advice for busy clusters)
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # transformWithState needs the RocksDB state store; changelog
    # checkpointing commits only the changes of each micro-batch
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app_name: str = "tracelens", extra: dict | None = None) -> SparkSession:
    """A local session for tests and benchmarks (UI off, UTC, AQE on)."""
    builder = (SparkSession.builder.master(f"local[{cores}]").appName(app_name)
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", os.environ.get("TRACELENS_DRIVER_MEMORY", "8g")))
    for k, v in {**DEFAULT_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    Only when the session has none (local tests) a scratch folder is created
    and set; on a cluster the configured shared folder is always used.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    current = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not current:
        # only when nothing is configured (local tests): a scratch folder
        if not sc.master.split("[")[0] == "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        current = tempfile.mkdtemp(prefix="tracelens-ckpt-")
        try:
            spark.conf.set("spark.checkpoint.dir", current)
        except Exception:  # noqa: BLE001 - core conf may be read-only at runtime
            pass
    sc.setCheckpointDir(current)
    return sc.getCheckpointDir() or current


def checkpoint_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder (for streaming queries)."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}"



def cluster_conf(input_bytes: int, total_cores: int, bytes_per_partition: int = 1 << 30,
                 max_partitions: int = 100_000) -> dict:
    """Settings for a large cluster run, from the input size and the number
    of executor cores.

    Shuffles start with about one partition per ``bytes_per_partition`` of
    input (at least twice the cores, at most ``max_partitions``: map x reduce
    blocks must stay manageable); most shuffles here carry partial
    aggregates, far less than the input, and AQE merges partitions down to
    its 256 MB advisory size and splits skewed join partitions.  Scan splits
    stay at 128 MB.  Apply with ``SparkSession.builder.config(...)`` or
    ``spark.conf.set`` before building the queries.
    """
    parts = -(-int(input_bytes) // bytes_per_partition)
    parts = min(max_partitions, max(2 * total_cores, parts))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 << 20),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.files.maxPartitionBytes": str(128 << 20),
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    }
