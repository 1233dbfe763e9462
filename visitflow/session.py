"""Session helpers: a local session for tests/bench, and the shared work folder.

On a cluster the work folder is the one the cluster names in
``spark.checkpoint.dir`` (a shared file system every executor sees). Only a
local-mode session without that setting gets a private temporary folder.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

_CHECKPOINT_KEY = "spark.checkpoint.dir"


def local_session(
    cores: int | str = "*",
    shuffle_partitions: int = 8,
    app_name: str = "visitflow",
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """A local-mode session with the settings the tests and bench use."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("VISITFLOW_DRIVER_MEMORY", "4g"))
    )
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for lineage cuts and scratch tables.

    Reads ``spark.checkpoint.dir`` (or a directory already set on the context).
    Only when neither is set *and* the master is local does it create a private
    folder and register it, as a test session needs; on a cluster a missing
    setting is an error, because a machine-local folder is not shared.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: the context lives on the server
        configured = spark.conf.get(_CHECKPOINT_KEY, None)
        if not configured:
            raise RuntimeError(f"{_CHECKPOINT_KEY} is not set on the server session")
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get(_CHECKPOINT_KEY, None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if sc.master != "local" and not sc.master.startswith("local["):  # local-cluster isn't one machine's
        raise RuntimeError(
            f"{_CHECKPOINT_KEY} is not set; a cluster job needs a shared folder for "
            "checkpoints and scratch tables"
        )
    local_dir = tempfile.mkdtemp(prefix="visitflow-ckpt-")
    sc.setCheckpointDir(local_dir)
    return sc.getCheckpointDir() or local_dir


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, never-reused folder under the shared work folder."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/visitflow/{label}-{uuid.uuid4().hex}"


def materialize(df):
    """Cut lineage with a reliable checkpoint in the shared checkpoint folder.

    For small intermediate results that several outputs read: they are computed
    once, and a lost executor does not force a recomputation from the source.
    """
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)
