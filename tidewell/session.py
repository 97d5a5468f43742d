"""Session settings for the jobs, and the shared folder they may write to."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

STATE_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

# Nothing here fixes a partition count: on a cluster AQE starts from the cluster's own
# spark.sql.shuffle.partitions and merges or splits from there.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A skewed join is split even when that costs one more exchange above it.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Rows that lie together by one key of a join need not be shuffled again for its other keys.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    # Partitions this small are hashed instead of sorted for a join.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
    # Read only the columns behind the struct fields that are asked for. Catalyst does not take a
    # struct apart by itself if its fields are more than plain columns. Parses and other costly
    # expressions are kept from being copied by with_column_once.
    "spark.sql.optimizer.collapseProjectAlwaysInline": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.streaming.stateStore.providerClass": STATE_PROVIDER,
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}

# Settings that only a new session can take.
STATIC = {
    # Else every Column call also records the line of Python it came from.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def configure(spark: SparkSession, zone: str = "UTC") -> SparkSession:
    """Apply the job settings to a session that somebody else built."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    spark.conf.set("spark.sql.session.timeZone", zone)
    return spark


def build_session(name: str = "tidewell", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **STATIC, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir`` of the session.

    A local session without that setting gets a fresh temporary folder. On a cluster each machine
    would write to its own, so there the setting is needed.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        found = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found and not spark.sparkContext.master.split("[")[0] == "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if not found:
        found = tempfile.mkdtemp(prefix="tidewell-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found
