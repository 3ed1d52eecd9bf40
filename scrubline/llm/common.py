"""What the operators share: white space, intermediate tables, sort keys."""

from __future__ import annotations

import sys
import types

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import shared_folder

# White space of every contract here: the blank and U+0009 to U+000D.
SPACE = r"[\x20\x09-\x0D]+"
# rows of a narrow intermediate table that are worth a file of their own
FILE_ROWS = 1 << 16


def text_or_empty(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def lower_ascii(text: Column) -> Column:
    """A-Z as a-z and all else as it is.  ``lower`` does that to texts of ASCII alone."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    ascii_only = F.octet_length(text) == F.char_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, upper, upper.lower()))


def words(text: Column) -> Column:
    """The words of a text, in order; null and blank texts have none."""
    return F.array_remove(F.split(text_or_empty(text), SPACE), "")


def stage(df: DataFrame, label: str, at_most: int | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage: what was computed is not computed again when an executor
    is lost, and every reader sees the same rows.  Written once and read a few
    times, so in the denser of the fast codecs.

    ``at_most``, where known, is a number of rows that ``df`` does not exceed: a small
    table is then a few files, in however many partitions it comes.  On a local file
    system each file costs the executor two processes.
    """
    path = shared_folder(df.sparkSession, label)
    if at_most is not None:
        df = df.coalesce(max(1, -(-at_most // FILE_ROWS)))
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def source_key(source: Column) -> Column:
    """A non-null key in code point order with the null source last."""
    return F.coalesce(F.concat(F.lit("a"), source), F.lit("b"))


def worker_value(key: object, make):
    """``make()``, kept for as long as this Python process asks for the same ``key``.

    Functions that are sent by value bring their own module variables to every
    task, so what a worker loads once is kept in a module of its own.  Only the
    last value is kept: a worker that serves several operators holds one model.
    """
    name = "_scrubline_llm_worker"
    held = sys.modules.setdefault(name, types.ModuleType(name)).__dict__
    if held.get("key") != key:
        held.update(key=None, value=None)
        held.update(key=key, value=make())
    return held["value"]
