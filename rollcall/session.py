"""Session settings for large runs, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

SCALE_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.parquet.filterPushdown": "true",
    # Recording the call site of every column expression costs more than building it.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def apply_settings(builder: SparkSession.Builder, **overrides: str) -> SparkSession.Builder:
    """Add the settings this package is tuned for; ``overrides`` win."""
    for key, value in {**SCALE_SETTINGS, **overrides}.items():
        builder = builder.config(key, value)
    return builder


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for written intermediate tables.

    ``spark.checkpoint.dir`` names it. Only a local session may go without: it gets a
    folder of its own. On a cluster a machine-local folder would be lost with its
    machine, so there a missing setting is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    folder = tempfile.mkdtemp(prefix="rollcall-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def new_scratch_path(spark: SparkSession, label: str) -> str:
    return f"{scratch_root(spark)}/rollcall/{label}-{uuid.uuid4().hex[:12]}"
