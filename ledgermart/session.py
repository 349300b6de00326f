"""Session settings and the shared folder for written intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
}

_LOCAL_FOLDER: str | None = None


def build_session(app: str, master: str | None = None, **extra: str) -> SparkSession:
    """A session with the settings the operators are designed for."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a ``local`` session may fall back to a temporary folder: there driver and
    executors are one process. On a cluster a missing setting is an error.
    """
    global _LOCAL_FOLDER
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    if _LOCAL_FOLDER is None:
        _LOCAL_FOLDER = tempfile.mkdtemp(prefix="ledgermart-")
    return _LOCAL_FOLDER


def new_work_dir(spark: SparkSession, label: str) -> str:
    """A fresh path (not yet created) below the shared folder."""
    return f"{shared_dir(spark)}/ledgermart/{label}-{uuid.uuid4().hex}"
