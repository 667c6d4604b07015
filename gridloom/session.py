"""Sessions with the settings that the engine relies on, and shared working space."""

from __future__ import annotations

import os
import tempfile
from urllib.parse import urlparse

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.python.filterPushdown.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Checkpoints that nothing refers to any more are deleted.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def session(name: str = "gridloom", master: str | None = None, **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    for key, value in (SETTINGS | settings).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_space(spark: SparkSession) -> str:
    """A folder that driver and executors see: the checkpoint folder, or a local one for a local session."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        shared = getattr(spark, "_gridloom_space", None) or tempfile.mkdtemp(prefix="gridloom-")
        spark._gridloom_space = shared
    return urlparse(shared).path if shared.startswith("file:") else shared


def allow(path: str) -> None:
    """Add a folder to those that local paths may be in."""
    from .sources.stores import ALLOW

    have = os.environ.get(ALLOW) or os.getcwd()
    if path not in have.split(os.pathsep):
        os.environ[ALLOW] = have + os.pathsep + path
