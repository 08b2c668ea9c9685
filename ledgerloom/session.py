"""Session settings and the shared scratch folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # valid and rejected rows leave one task as two files without a sort
    "spark.sql.maxConcurrentOutputFileWriters": "4",
    "spark.ui.enabled": "false",
}


def session(app_name: str = "ledgerloom", master: str | None = None, **settings: str) -> SparkSession:
    """Build (or get) a session; ``settings`` use ``__`` for the dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for name, value in SETTINGS.items():
        builder = builder.config(name, value)
    for name, value in settings.items():
        builder = builder.config(name.replace("__", "."), value)
    return builder.getOrCreate()


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder for intermediate tables, under ``spark.checkpoint.dir``.

    The cluster's setting wins. Only a local session without one gets a
    temporary folder of its own, removed when Python ends, because executors on other
    machines could not read it. Tables in a cluster's folder stay until it is cleared.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not root:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        own = tempfile.mkdtemp(prefix="ledgerloom-")
        atexit.register(shutil.rmtree, own, ignore_errors=True)
        context.setCheckpointDir(own)
        root = context.getCheckpointDir()
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
