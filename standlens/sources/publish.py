"""Hand-offs that survive a failed rewrite.

A published set is a folder of versions and a manifest. A new version is written beside the old ones; only when Spark has committed
it does the manifest, a small JSON table that grows by one row, name it. Readers follow the manifest's last row, so a write that
fails half-way leaves them the last good version, and a reader that has begun keeps the files it reads. ``prune`` deletes versions
that newer ones have replaced.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

MANIFEST = "manifest"
SCHEMA = "seq long, version string"


def _published(spark: SparkSession, root: str) -> list[str]:
    """Versions in the order of their publication; none if ``root`` is no published set."""
    try:
        rows = spark.read.schema(SCHEMA).json(f"{root}/{MANIFEST}").orderBy("seq", "version").collect()     # one a publication
    except AnalysisException:
        return []
    return [r.version for r in rows]


def publish(spark: SparkSession, root: str, write: Callable[[str], None]) -> str:
    """Have ``write`` write a new version of the set in ``root``, then name it in the manifest; its path."""
    root = root.rstrip("/")
    version = f"v-{uuid.uuid4().hex}"
    write(f"{root}/{version}")
    row = spark.range(1).select(F.lit(len(_published(spark, root))).cast("long").alias("seq"), F.lit(version).alias("version"))
    row.write.mode("append").json(f"{root}/{MANIFEST}")
    return f"{root}/{version}"


def current(spark: SparkSession, root: str) -> str:
    """The path of the version published last; ``root`` itself where there is no manifest (a single version, or a plain folder)."""
    root = root.rstrip("/")
    versions = _published(spark, root)
    return f"{root}/{versions[-1]}" if versions else root


def prune(spark: SparkSession, root: str, keep: int = 1) -> list[str]:
    """Delete all published versions but the last ``keep``; the names of those deleted. What is not in the manifest stays: it
    may be a version that is being written."""
    root = root.rstrip("/")
    versions = _published(spark, root)
    old = [v for v in versions[:-keep] if v not in versions[-keep:]]
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    gone = []
    for v in old:
        path = jvm.org.apache.hadoop.fs.Path(f"{root}/{v}")
        if path.getFileSystem(conf).delete(path, True):
            gone.append(v)
    return gone
