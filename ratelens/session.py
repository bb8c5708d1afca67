"""Session construction and the shared scratch / checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(
    master: str | None = None,
    shuffle_partitions: int | None = None,
    app_name: str = "ratelens",
    extra: dict[str, str] | None = None,
    checkpoints: bool = True,
) -> SparkSession:
    """Session with the settings the plans are written for.

    AQE stays on: it coalesces small shuffle partitions and, as a runtime
    backstop to the explicit salting in ``operators.joins``, splits skewed
    join partitions.  The UI is off (no server port is opened).
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # Post-shuffle partitions of about 128 MiB: large enough to keep task
        # counts sane at scale, small enough that aggregations do not spill.
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
        # Checkpoint files (ordinal positions) are removed once unreferenced.
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        "spark.sql.session.timeZone": "UTC",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    if checkpoints:  # the reports as such need no checkpoint folder
        checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Reliable checkpoint folder of the session.

    Uses the folder the cluster names (``spark.checkpoint.dir`` or one already
    set on the context).  Only a local-mode session without one gets a fresh
    temporary folder; on a cluster a machine-local folder would not survive the
    loss of an executor, so an unset folder is an error there.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: the context lives on the server
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if configured:
            return configured
        raise RuntimeError("spark.checkpoint.dir is not set on the server session")
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
    elif sc.master.startswith("local"):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="ratelens-ckpt-"))
    else:
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at a shared folder "
            "(HDFS/S3/ABFS) that every executor can read"
        )
    return sc.getCheckpointDir()


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder on whatever store its path names; absent is fine."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def session_key(spark: SparkSession) -> tuple:
    """Identity of a session for per-session memos."""
    return (spark.conf.get("spark.app.id", ""), id(spark))


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared checkpoint folder."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/ratelens-scratch/{label}-{os.getpid()}-{uuid.uuid4().hex}"
