"""Session settings and shared scratch space."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from functools import cache

from pyspark.sql import SparkSession


def build_session(app: str = "tapespark", master: str | None = None, **settings) -> SparkSession:
    """A session with the settings the operators are tuned for.

    A cluster normally hands over its own session; nothing in the library relies on
    these settings for right results, only for good plans.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # Recording the Python call site of every Column takes longer than short queries do.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        # Days that are ingested at the same time share the slots.
        "spark.scheduler.mode": "FAIR",
        # A task which writes a few days keeps a writer per day instead of sorting its rows.
        "spark.sql.maxConcurrentOutputFileWriters": "16",
    }
    for key, value in {**defaults, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@cache
def _local_root() -> str:
    """One folder of a local session, removed when its process ends."""
    root = tempfile.mkdtemp(prefix="tapespark-")
    atexit.register(shutil.rmtree, root, ignore_errors=True)
    return root


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh folder under the shared one named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a machine-local folder: on a cluster the
    other executors could not see it.  What is stored under ``spark.checkpoint.dir`` outlives
    the session, as results may still be read from it: whoever owns that folder empties it.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        root = _local_root()
    return f"{root.rstrip('/')}/tapespark/{label}-{uuid.uuid4().hex}"
