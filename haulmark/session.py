"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the package relies on. Shuffle partition counts are left to the
# cluster; adaptive execution coalesces and splits them at run time.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Wide typed projections generate methods longer than the 8000 bytecodes HotSpot
    # compiles. Past that limit Spark splits the expressions into smaller methods.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}

# The settings above that may be changed on a running session.
_RUNTIME = ("spark.sql.codegen.hugeMethodLimit", "spark.sql.session.timeZone")


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session that was built elsewhere."""
    for key in _RUNTIME:
        spark.conf.set(key, SETTINGS[key])
    return spark


def build_session(app_name: str = "haulmark", master: str | None = None,
                  **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Root for intermediate files that every executor must be able to reach.

    The cluster names it in ``spark.checkpoint.dir``. Only a local master, where
    driver and executors share one disk, falls back to a temporary folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    return os.path.join(tempfile.gettempdir(), "haulmark-scratch")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder; never reused between runs."""
    return f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
