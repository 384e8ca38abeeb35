"""SparkSession helpers shared by tests, bench and the driver entry point."""

from __future__ import annotations

import os
import tempfile

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession

# Settings every mart relies on. Timestamps are TIMESTAMP_NTZ end to end and the
# session zone is pinned, so no wall-clock conversion can shift a bound.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join even when that needs one more shuffle above it: the
    # aggregates above then run partially on the split pieces first.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    # AQE merges partitions up to this size (as shuffled, compressed); a task's sort
    # takes about 15 times that.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(16 * 1024 * 1024),
    # Broadcast only what is small in memory; larger sides fall back to sort-merge
    # joins with AQE skew splitting. The planner's estimate is the size of the
    # compressed files and doesn't count the copies that an explode makes, so the
    # hash table of a side can be 30 times its estimate, and 100 times for a band
    # exploded into days. AQE measures rows as they are in memory; their hash
    # table is about 3 times that.
    "spark.sql.autoBroadcastJoinThreshold": str(1024 * 1024),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(16 * 1024 * 1024),
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


# Sizing for a large cluster (about 1000 executors, inputs of 100 TB): start
# shuffles wide and let AQE coalesce them to the advisory size; read Parquet in
# 256 MiB splits; call a shuffle partition skewed above 512 MiB. The shared
# checkpoint folder is the cluster's own ``spark.checkpoint.dir``.
CLUSTER_CONF = {
    "spark.sql.shuffle.partitions": "8000",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "8000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * 1024 * 1024),
    "spark.sql.files.maxPartitionBytes": str(256 * 1024 * 1024),
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(512 * 1024 * 1024),
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
}


def build_session(master: str | None = "local[8]", shuffle_partitions: int | None = 8,
                  app: str = "callcredit", extra: dict | None = None,
                  profile: str | None = None) -> SparkSession:
    """Build (or get) the session. ``profile="cluster"``, the default for any
    master but a local one, applies CLUSTER_CONF and leaves memory to the
    cluster manager, and the master too if only a local one is given."""
    here = (master or "").startswith("local")
    profile = profile or ("local" if here else "cluster")
    builder = SparkSession.builder.appName(app)
    if master and (profile != "cluster" or not here):
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if profile == "cluster":
        conf.update(CLUSTER_CONF)
    else:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions or 8)
        conf["spark.driver.memory"] = os.environ.get("CALLCREDIT_DRIVER_MEMORY", "8g")
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    if spark.sparkContext.master.startswith("local"):
        ensure_checkpoint_dir(spark)
    return spark


def apply_session_conf(spark: SparkSession) -> None:
    """Apply the runtime-settable part of BASE_CONF to a session we did not build."""
    for k, v in BASE_CONF.items():
        if k in ("spark.ui.enabled",):
            continue
        try:
            spark.conf.set(k, v)
        except AnalysisException:  # static conf on a running session: leave as is
            pass


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster.

    ``spark.checkpoint.dir`` is read from the session; only when it is unset
    (local tests) a fresh scratch folder is created and registered.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or \
        spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if configured:
        spark.sparkContext.setCheckpointDir(configured)
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir is not set: name a folder shared by the cluster")
    local = tempfile.mkdtemp(prefix="callcredit-ckpt-")
    spark.conf.set("spark.checkpoint.dir", local)
    spark.sparkContext.setCheckpointDir(local)
    return local
