"""Parquet snapshots and reuse of a table."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel


def write_snapshot(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` as parquet, replacing what was there, and read it back.

    Later passes then prune columns and skip row groups, and a lost executor
    costs a re-read instead of the whole lineage.
    """
    df.write.mode("overwrite").option("compression", "snappy").parquet(path)
    return read_snapshot(df.sparkSession, path, df)


def read_snapshot(
    spark: SparkSession, path: str, like: DataFrame | None = None
) -> DataFrame:
    """Read a snapshot; with ``like``, by its schema instead of a file footer."""
    reader = spark.read if like is None else spark.read.schema(like.schema)
    return reader.parquet(path)


def publish_snapshot(df: DataFrame, path: str, keep: int = 2) -> DataFrame:
    """Write ``df`` as the next version of the table at ``path`` and read it back.

    Each version has a folder of its own below ``path``, and ``path/published`` lists them.
    The list is added to when the version is whole, so readers see the former version until then,
    and what they began to read stays: only versions before the last ``keep`` are
    removed.  A version that failed is never listed, and goes with the next clean-up.  One
    writer at a time.
    """
    if keep < 1:
        raise ValueError("keep at least the version that is written")
    spark, listed = df.sparkSession, _listed(df.sparkSession, path)
    number = max(listed, default=0) + 1
    folder = f"v{number:08d}-{uuid.uuid4().hex[:8]}"
    df.write.option("compression", "snappy").parquet(f"{path}/{folder}")
    entry = spark.range(1).select(F.lit(number).cast("bigint").alias("number"), F.lit(folder).alias("folder"))
    entry.coalesce(1).write.mode("append").parquet(f"{path}/published")
    kept = {folder, *(listed[n] for n in sorted(listed)[max(0, len(listed) - keep + 1) :])} if keep > 1 else {folder}
    _remove_others(spark, path, kept)
    return spark.read.schema(df.schema).parquet(f"{path}/{folder}")


def read_published(spark: SparkSession, path: str, back: int = 0) -> DataFrame:
    """The last published version of the table at ``path``, or the one ``back`` before it."""
    listed = _listed(spark, path)
    if len(listed) <= back:
        raise FileNotFoundError(f"{path} has {len(listed)} published versions")
    return spark.read.parquet(f"{path}/{listed[sorted(listed)[-1 - back]]}")


def _folder(spark: SparkSession, path: str):
    """The file system of ``path`` and the path as it knows it."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def _listed(spark: SparkSession, path: str) -> dict[int, str]:
    """The folders of the published versions by number; a version is a row, so there are few."""
    files, where = _folder(spark, f"{path}/published")
    if not files.exists(where):
        return {}
    rows = spark.read.schema("number bigint, folder string").parquet(f"{path}/published")
    return {r["number"]: r["folder"] for r in rows.collect()}


def _remove_others(spark: SparkSession, path: str, kept: set[str]) -> None:
    """Remove the folders of versions that are not in ``kept``, listed or failed."""
    files, where = _folder(spark, path)
    for status in files.listStatus(where):
        name = status.getPath().getName()
        if re.fullmatch(r"v\d{8}-[0-9a-f]{8}", name) and name not in kept:
            files.delete(status.getPath(), True)


@contextmanager
def persisted(df: DataFrame) -> Iterator[DataFrame]:
    """Keep ``df`` in memory, or on executor disks, inside the block.

    For a narrow table that several passes read; a snapshot serves a wide one.
    """
    kept = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield kept
    finally:
        kept.unpersist()
