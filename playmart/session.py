"""Session helpers.

The library never hard-codes cluster settings into operators. ``build_session``
is what tests and ``bench.py`` use; on a cluster the session comes from the
platform and only ``shared_dir`` is consulted.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that matter for the plans in this package. All are Spark defaults
# or size thresholds; none forces a join strategy.
SCALE_DEFAULTS = {
    # Runtime re-planning: coalesce small shuffles, split skewed join
    # partitions, turn a sort-merge join into a broadcast join only when the
    # measured shuffle output of one side is below the threshold.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",
    "spark.sql.autoBroadcastJoinThreshold": "32MB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128MB",
    "spark.sql.files.maxPartitionBytes": "128MB",
    "spark.sql.session.timeZone": "UTC",
}


def build_session(master: str | None = None, shuffle_partitions: int = 8, app: str = "playmart") -> SparkSession:
    """Local/test session with the UI off and a scratch checkpoint folder."""
    master = master or os.environ.get("PLAYMART_MASTER", "local[8]")
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in SCALE_DEFAULTS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    shared_dir(spark)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this setting names storage every executor can reach, and it
    is an error to leave it unset. In a local session (tests, bench) a scratch
    folder is created and set instead.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # a remote (Connect) session has no SparkContext
        sc = None
    if sc is not None:
        configured = configured or sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        master = sc.master if sc is not None else ""
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="playmart-ckpt-")
    if sc is not None and not sc.getCheckpointDir():
        sc.setCheckpointDir(configured)
    return configured.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused path under the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
