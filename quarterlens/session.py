"""Spark session helpers.

On a cluster the session comes from the platform, with
``spark.checkpoint.dir`` pointing at shared storage.  Locally (tests, bench)
we build a session ourselves and only then pick a scratch checkpoint folder.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def local_session(cpus: int | str = "*", shuffle_partitions: int = 16,
                  app_name: str = "quarterlens") -> SparkSession:
    """A local session tuned like the cluster one: AQE on, UTC, no UI."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        # Coalesce small shuffle partitions, but not below 256 KB: the default
        # 1 MB floor would serialise stages whose input is small but whose
        # output is not (the month explode multiplies rows ~7x).  Measured
        # best of the local settings tried; the cluster keeps its defaults.
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "256k")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("QL_DRIVER_MEMORY", "8g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def scratch_folder(spark: SparkSession, tag: str) -> str:
    """A fresh folder under the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/quarterlens/{tag}-{uuid.uuid4().hex}"


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder, picking a scratch one only if unset.

    A cluster names a shared folder in ``spark.checkpoint.dir`` (a core
    setting, fixed at start-up); that value always wins.  Only a bare local
    session without it (tests) gets a fresh temporary folder, set on the
    context directly since the setting itself cannot change at runtime.
    """
    sc = spark.sparkContext
    configured = sc.getConf().get(CHECKPOINT_CONF, None) or spark.conf.get(CHECKPOINT_CONF, None)
    if configured:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(configured)
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    if sc.master.split("[")[0] != "local":  # local-cluster has executors of its own
        raise RuntimeError(
            f"{CHECKPOINT_CONF} is not set; a cluster job needs a shared checkpoint folder")
    folder = tempfile.mkdtemp(prefix="ql-ckpt-")
    sc.setCheckpointDir(folder)
    return folder
