"""Spark session helpers.

Library code never creates a session; it takes the one it is given. These
helpers are for tests, the bench and command-line use.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings of the local sessions (Spark's defaults but for the last): AQE for runtime
# join choice, partition coalescing and skew splitting; checkpoints go when unused.
LOCAL_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "tillroll", extra: dict | None = None) -> SparkSession:
    """A local session for tests and the bench.

    A scratch checkpoint folder is made only when the caller gives none
    (``extra['spark.checkpoint.dir']``), as tests do.
    """
    extra = dict(extra or {})
    if "spark.checkpoint.dir" not in extra:
        extra["spark.checkpoint.dir"] = tempfile.mkdtemp(
            prefix="tillroll-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in {**LOCAL_CONF, **extra}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared folder the cluster names in ``spark.checkpoint.dir`` (or None)."""
    sc = spark.sparkContext
    return sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None) \
        or spark.conf.get("spark.checkpoint.dir", None)


def ensure_checkpoint_dir(spark: SparkSession, scratch_if_unset: bool = False) -> str | None:
    """Make ``checkpoint()`` use the session's ``spark.checkpoint.dir``.

    With ``scratch_if_unset`` a fresh local folder is taken when a *local* session
    names none; on a cluster, whose machines share no such folder, that is an error.
    """
    sc = spark.sparkContext
    current = checkpoint_dir(spark)
    if not current and scratch_if_unset:
        if sc.master != "local" and not sc.master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        current = tempfile.mkdtemp(prefix="tillroll-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    if current and not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    return current


def delete_on_exit(spark: SparkSession, path: str) -> None:
    """Let the file system remove ``path`` when the application ends."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(p)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder this library wrote."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
