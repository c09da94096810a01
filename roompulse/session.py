"""Session settings that the jobs rely on."""

from __future__ import annotations

import os

from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Batch shuffles start with many partitions, small enough for an executor even when tens of TB are
# shuffled; AQE merges them towards the advisory size where there is less.
CLUSTER_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.files.maxPartitionBytes": "256m",
}

# State lives in RocksDB on the executors' disks, with incremental uploads to the checkpoint,
# so window and device state is bounded by disk and not by the JVM heap.
STATE_STORE_CONF = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


STATE_PARTITIONS = "spark.roompulse.statePartitions"


def build_session(app_name: str = "roompulse", conf: Mapping[str, str] | None = None) -> SparkSession:
    """A session for spark-submit; master and resources come from the submit command."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**CLUSTER_CONF, **STATE_STORE_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@contextmanager
def session_conf(spark: SparkSession, conf: Mapping[str, str]) -> Iterator[None]:
    """Set SQL settings for a block and restore the previous ones after it."""
    before = {key: spark.conf.get(key, None) for key in conf}
    for key, value in conf.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def state_conf(spark: SparkSession) -> dict[str, str]:
    """Settings for a stateful stream.

    The number of state partitions is fixed for the life of a checkpoint, and AQE does not change it. It is
    the setting ``STATE_PARTITIONS`` where that is given, else the session's shuffle partitions (200 unless
    set): never what happens to have registered when the job starts.
    """
    partitions = spark.conf.get(STATE_PARTITIONS, None) or spark.conf.get("spark.sql.shuffle.partitions")
    return {**STATE_STORE_CONF, "spark.sql.shuffle.partitions": str(partitions)}


def importable(spark: SparkSession) -> None:
    """Let Python workers import this package where it isn't installed; spark-submit ships it with ``--py-files``."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    paths = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in paths.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [root, paths]))
