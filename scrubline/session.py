"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Adaptive execution sizes the shuffles at run time, so the initial partition
# number only has to be large enough for the biggest exchange.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.compression.codec": "snappy",
    # The JVM interprets methods beyond this size; a wide projection then runs
    # faster outside whole-stage code generation.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.ui.enabled": "false",
}


def build_session(
    app_name: str = "scrubline", master: str | None = None, **settings: object
) -> SparkSession:
    """A session with the library's settings.

    ``settings`` adds to or replaces them; write dots as double underscores
    (``spark__sql__shuffle__partitions=8``).  ``master`` is left to
    spark-submit unless given.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    merged = SETTINGS | {k.replace("__", "."): str(v) for k, v in settings.items()}
    for key, value in merged.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder that every executor reaches, another one for each call.

    It lies below ``spark.checkpoint.dir``, or below the folder given to
    ``SparkContext.setCheckpointDir``.  Where neither is set, a local master
    (one machine, so every folder is shared) sets its own; a cluster is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        # spark.checkpoint.dir itself cannot change in a running session
        spark.sparkContext.setCheckpointDir(f"{tempfile.gettempdir()}/scrubline-shared")
        root = spark.sparkContext.getCheckpointDir()
    return f"{root.rstrip('/')}/scrubline/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
