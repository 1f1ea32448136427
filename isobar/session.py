"""Session settings and the folder all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(app_name: str = "isobar", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the jobs assume. Cluster settings given to spark-submit win.

    Only what changes results (zone) or is a safe default at any size (AQE) is set here; partition
    counts and memory belong to the deployment, or to `conf` in tests and benches.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # Copies that a batch staged go when nothing refers to them any more.
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """The checkpoint folder of the session; a scratch folder only in local mode without one."""
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if root is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="isobar-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(root)
    return root


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder name below the shared root."""
    return f"{shared_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
