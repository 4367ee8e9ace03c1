"""Session helpers: local sessions for tests and the checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings that matter at scale as well as locally: AQE re-plans at each
# exchange, coalesces small shuffle partitions and splits skewed join
# partitions; the session zone is pinned so year() never shifts.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "3",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    # checkpoints of distributed ranks / quantiles are dropped once unreferenced
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def local_session(cores: int | str = 8, shuffle_partitions: int = 8, app: str = "standlens") -> SparkSession:
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    conf = dict(SCALE_CONF)
    conf.update({
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.driver.memory": "16g",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    })
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """SCALE_CONF on a session that is already there (spark-submit), as far as settings can still change."""
    for k, v in SCALE_CONF.items():
        if k.startswith("spark.sql."):
            spark.conf.set(k, v)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for written tables and checkpoints.

    It is whatever ``spark.checkpoint.dir`` names (on a cluster a shared file system). Only a local session (tests) that
    has none gets a scratch folder; elsewhere executors would each write to a disk of their own, so that is an error.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="standlens-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        spark.sparkContext.setCheckpointDir(d)
    return d
