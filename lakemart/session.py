"""Spark session settings the pipeline relies on."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

SETTINGS = {
    # Business times carry no zone; audit times are UTC instants.
    "spark.sql.session.timeZone": "UTC",
    # Casts in staging must abort on a bad value instead of returning null.
    "spark.sql.ansi.enabled": "true",
    # Partition counts and skewed joins are re-planned from observed sizes.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Recording the Python call site of every expression slows the building of plans.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app_name: str = "lakemart", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings above; ``conf`` keys use ``__`` in place of dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master).config("spark.ui.enabled", "false")
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


_local: dict[str, str] = {}


def work_path(spark: SparkSession, name: str) -> str:
    """A new path for tables of one run, in the folder that the cluster names in spark.checkpoint.dir.

    Without that setting a folder of this machine is taken, only where the master is local.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        app = spark.sparkContext
        if not app.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = _local.setdefault(app.applicationId, "") or tempfile.mkdtemp(prefix="lakemart-")
        _local[app.applicationId] = root
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
