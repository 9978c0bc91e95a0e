"""Session settings and the shared working folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from functools import cache

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"

SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A hot join key is split at run time, even where that costs one more shuffle.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # The JVM never compiles a method above 8000 bytes of bytecode; a plan with long CASE chains runs
    # faster as several smaller methods than as one interpreted stage.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Keys of streaming deduplication live on disk, not on the executors' heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # Of a key given twice in a JSON object the last one counts.
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(app: str = "lakeloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the jobs expect; ``conf`` overrides any of them."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@cache
def _local_root(application_id: str) -> str:
    return tempfile.mkdtemp(prefix="lakeloom-")


def _shared_root(spark: SparkSession) -> str:
    root = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getConf().get(CHECKPOINT_CONF)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder that every executor can reach")
    return _local_root(spark.sparkContext.applicationId)


def workspace(spark: SparkSession, label: str) -> str:
    """A new folder name under the cluster's shared folder.

    A temporary folder stands in only on a local master, where driver and executors are one process.
    """
    return f"{_shared_root(spark)}/{label}-{uuid.uuid4().hex}"


def enable_checkpoints(spark: SparkSession) -> None:
    """Point ``DataFrame.checkpoint`` at the shared folder unless the cluster already did."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(os.path.join(_shared_root(spark), "rdd"))
