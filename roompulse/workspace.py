"""Shared folders for tables, checkpoints and models that a job writes."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from functools import lru_cache

from pyspark.sql import SparkSession


@lru_cache(maxsize=1)
def _local_root() -> str:
    root = tempfile.mkdtemp(prefix="roompulse-")
    atexit.register(shutil.rmtree, root, ignore_errors=True)
    return root


def shared_root(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; only a local master may do without it."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        configured = spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if spark.sparkContext.master.startswith("local"):
        return _local_root()
    raise ValueError("set spark.checkpoint.dir to a folder that all executors share")


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder name below the shared root, one per call."""
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"
