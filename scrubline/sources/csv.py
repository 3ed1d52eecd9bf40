"""CSV files with doubled quotes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scrubline.sources.names import normalize_columns
from scrubline.sources.parquet import write_snapshot

# The dialect.
DIALECT = {"header": "true", "sep": ",", "quote": '"', "escape": '"', "encoding": "UTF-8"}
MALFORMED = "malformed_line"


def read_csv(
    spark: SparkSession,
    paths: str | list[str],
    schema: T.StructType | None = None,
    infer: bool = False,
    multi_line: bool = True,
    strict: bool = False,
) -> DataFrame:
    """Read CSV files, all columns as text unless told otherwise.

    A ``schema`` must match the header of every file, name by name.  ``infer``
    costs a pass over the data and can misread text such as the version
    ``1.10``.  ``multi_line`` reads line breaks inside quotes, for which a file
    has to stay whole: many files are read in parallel, one file is not.  Turn
    it off for large files without such line breaks, and keep the result with
    :func:`~scrubline.sources.parquet.write_snapshot` so that the text is
    parsed only once.

    A row with too few fields is filled up with NULL and one with too many loses
    the rest; :func:`malformed_rows` finds both, ``strict`` fails on them.
    """
    mode = "FAILFAST" if strict else "PERMISSIVE"
    reader = spark.read.options(**DIALECT, multiLine=multi_line, mode=mode)
    if schema is not None:
        reader = reader.schema(schema).option("enforceSchema", False)
    elif infer:
        reader = reader.option("inferSchema", True)
    return reader.csv(paths)


def malformed_rows(
    spark: SparkSession,
    paths: str | list[str],
    schema: T.StructType,
    out: str,
    multi_line: bool = True,
) -> DataFrame:
    """Keep the rows with more or fewer fields than ``schema`` as a parquet table ``out``.

    It has the fields that could be read and the raw row as ``malformed_line``.
    One more pass over the files, without a shuffle.
    """
    checked = T.StructType([*schema.fields, T.StructField(MALFORMED, T.StringType())])
    reader = spark.read.options(**DIALECT, multiLine=multi_line, enforceSchema=False)
    # A pruned scan would not count the fields of a row.
    reader = reader.options(columnNameOfCorruptRecord=MALFORMED, columnPruning=False)
    rows = reader.schema(checked).csv(paths).where(F.col(MALFORMED).isNotNull())
    return write_snapshot(normalize_columns(rows), out)


def write_csv(df: DataFrame, path: str) -> None:
    """Write CSV files that :func:`read_csv` reads back with their padding."""
    keep = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    df.write.mode("overwrite").options(**DIALECT, **keep).csv(path)
