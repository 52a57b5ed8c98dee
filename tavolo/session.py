"""Session helpers: a local session for tests and a checkpoint folder.

On a cluster the checkpoint folder comes from ``spark.checkpoint.dir`` (a
shared file system path the cluster names). Only where nothing is configured
and the master is local, as in tests, a fresh private folder is made, and
removed at the end; on a cluster a missing setting is an error.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int = 8, shuffle_partitions: int = 8) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tavolo")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def private_checkpoint_dir(master: str) -> str:
    """A folder of this machine, which is also that of every executor only under a ``local`` master."""
    if master.split("[")[0] != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    path = tempfile.mkdtemp(prefix="tavolo-ckpt-", dir="/tmp")
    atexit.register(shutil.rmtree, path, ignore_errors=True)
    return path


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder, configuring one only if none is set."""
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: the folder is the session setting
        current = spark.conf.get("spark.checkpoint.dir", None)
        if not current:
            current = private_checkpoint_dir(spark.conf.get("spark.master", "remote"))
            spark.conf.set("spark.checkpoint.dir", current)
        return current
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
    else:
        sc.setCheckpointDir(private_checkpoint_dir(sc.master))
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the checkpoint folder for job outputs (sinks, state)."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex}"
