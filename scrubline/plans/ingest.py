"""From CSV files to a parquet table."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from scrubline.sources.csv import read_csv
from scrubline.sources.names import normalize_columns
from scrubline.sources.parquet import write_snapshot
from scrubline.sources.tables import text_schema


def land_csv(
    spark: SparkSession,
    paths: str | list[str],
    out: str,
    headers: Iterable[str] | None = None,
    multi_line: bool = True,
    strict: bool = False,
) -> DataFrame:
    """Read CSV files, normalise the column names, keep the table as parquet.

    Everything later reads the returned snapshot, so the text is parsed once.
    ``strict`` fails on rows with too many or too few fields.
    """
    schema = text_schema(headers) if headers else None
    raw = read_csv(spark, paths, schema, multi_line=multi_line, strict=strict)
    return write_snapshot(normalize_columns(raw), out)
