"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import sys
import uuid

from pyspark import cloudpickle
from pyspark.sql import SparkSession

#: Settings every job relies on. Joins carry no broadcast hints: adaptive execution broadcasts a side
#: only after it has measured it, and splits the hot partitions of a sort-merge join.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Stream state on local disk, with its changes written to the checkpoint: it may outgrow the heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def build_session(app: str = "gaugeloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the defaults above; keyword names use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh path under ``spark.checkpoint.dir``, or, where that is unset, under the session's warehouse, which tasks share too."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/scratch"
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def ship_with_tasks(module: str) -> None:
    """Send a module's functions inside the task, so executors need not have this package installed."""
    cloudpickle.register_pickle_by_value(sys.modules[module])
