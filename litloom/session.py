"""Spark session factory."""

from __future__ import annotations

import tempfile
from collections.abc import Mapping
from pathlib import Path
from shutil import make_archive

from pyspark.sql import SparkSession

#: Settings every run needs, whatever the cluster; sizes are left to the cluster.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    "spark.sql.debug.maxToStringFields": "200",
    "spark.sql.broadcastTimeout": "3000",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(app_name: str = "litloom", master: str | None = None, conf: Mapping[str, str] | None = None) -> SparkSession:
    """A session with DEFAULTS, overridden by conf; master is only set where given."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, read from the session.

    Only where that is unset and the master is local is a folder made here.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if found:
        return found
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    spark.conf.set("spark.checkpoint.dir", made := tempfile.mkdtemp(prefix="litloom-"))
    return made


def ship_package(spark: SparkSession) -> None:
    """Sends this package to the Python workers, once for each application; their path may lack it."""
    context = spark.sparkContext
    if not getattr(context, "_litloom_shipped", False):
        root = Path(__file__).resolve().parents[1]
        context.addPyFile(make_archive(f"{tempfile.mkdtemp(prefix='litloom-')}/litloom", "zip", root, "litloom"))
        context._litloom_shipped = True
