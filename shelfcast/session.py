"""Spark session helpers.

Cluster settings (checkpoint dir, shuffle width, memory) belong to whoever
launches the job; these helpers only fill in what is unset, so the same code
runs under ``spark-submit`` on a cluster and under ``local[N]`` in tests.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job in this package relies on. They are defaults, not
# overrides: a value already present in the session wins.
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Joins on (series key, day) or (series key, week) may reuse a partitioning
    # on the series key alone. Safe for the panel because, after aggregation to
    # one row per series and day, no series holds more rows than there are days.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
}



def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "shelfcast") -> SparkSession:
    """Create (or fetch) a session for local runs and tests."""
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    b = b.config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    b = b.config("spark.driver.memory", os.environ.get("SHELFCAST_DRIVER_MEMORY", "16g"))
    for k, v in _DEFAULTS.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_defaults(spark)
    return spark


def ensure_defaults(spark: SparkSession) -> None:
    """Apply package defaults only where the session leaves them unset."""
    for k, v in _DEFAULTS.items():
        if spark.conf.get(k, None) is None:
            spark.conf.set(k, v)
    checkpoint_dir(spark)


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and staged tables.

    On a cluster this is ``spark.checkpoint.dir`` (a shared file system the
    cluster names) or the folder the launcher gave to ``setCheckpointDir``.
    Only a local master without either (tests, laptops) gets a scratch folder;
    elsewhere a machine's own folder would be wrong, so that is an error.
    """
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not d:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="shelfcast-ckpt-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


def stage_table(df, name: str):
    """Cut lineage by writing ``df`` as Parquet under the shared checkpoint
    folder and reading it back. Returns (frame, path); the caller may
    ``drop_path`` it once nothing reads it any more."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path), path


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a staged folder through the Hadoop file system API."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
