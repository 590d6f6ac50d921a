"""SparkSession construction and the shared checkpoint folder.

On a cluster the session arrives fully configured and ``spark.checkpoint.dir``
names a shared folder; we only read it.  Locally (tests, bench) we fill in the
settings that are unset.
"""

from __future__ import annotations

import os
import re

from pyspark import SparkConf
from pyspark.sql import SparkSession

# Settings a local run needs; cluster sessions already carry their own values.
LOCAL_DEFAULTS = {
    "spark.sql.shuffle.partitions": "8",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even when the split needs one more shuffle (the
    # load's product join feeds an aggregate on the same partitioning).
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # An idle master-data stream must not hold back the TTL of waiting rows.
    "spark.sql.streaming.multipleWatermarkPolicy": "max",
    # Join state (waiting transactions, customer master rows) lives in RocksDB
    # on local disk, not on the JVM heap, and is checkpointed incrementally.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def build_session(master: str | None = None, app: str = "sparkmart",
                  conf: dict[str, str] | None = None) -> SparkSession:
    """The caller's session as it is, if there is one.  Otherwise a new one:
    ``master`` and ``conf`` hold, what spark-submit or the defaults file has
    set stays, and the local defaults fill the rest of a run without a
    cluster."""
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    given = SparkConf()
    local = (master or given.get("spark.master", "local")).startswith("local")
    settings = dict(conf or {})
    if local:
        settings = {**{k: v for k, v in LOCAL_DEFAULTS.items() if not given.contains(k)}, **settings}
        settings.setdefault("spark.driver.memory", given.get("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "16g")))
    builder = SparkSession.builder.appName(app)
    if master or not given.contains("spark.master"):
        builder = builder.master(master or f"local[{os.environ.get('BENCH_CPUS', '8')}]")
    for k, v in settings.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for lineage cuts and materialised tables.

    Uses ``spark.checkpoint.dir`` when the cluster names one.  When it is unset
    (local runs; elsewhere that is an error) the folder is placed under the session's SQL warehouse
    directory and registered as the checkpoint dir, so ``DataFrame.checkpoint``
    works as well.
    """
    # The configured name is stable across sessions; SparkContext appends a
    # per-application sub-folder for RDD checkpoints, which we do not reuse.
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root and not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    if not root:
        root = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_sparkmart"
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")
