"""Exact duplicates by content sort, with DataFrame functions only.

Sampled splitters deal the normalised texts out by range, the sort puts equal
texts next to each other, and comparing neighbours in full ends a run.  The
splitters are made of the first characters, a hash of the whole text and a salt,
so that what the sampling sends to the driver is small whatever the texts; the
comparison of neighbours is on whole texts.

A text with more than ``limit`` copies would be one run in one task.  Its copies
get a salt and become several runs, and the smallest identifier and the count of
the whole group come from an aggregate that is made before the rows leave their
task.  ``limit`` is at least the rows divided by ``MAX_HOT``, so there are fewer
than ``MAX_HOT`` such texts, which bounds the broadcast.

Defined cases: a null text counts as empty; an empty text is a text like any
other; a null identifier is larger than any other; of rows with the same smallest
identifier and equal texts one stays; an empty table gives an empty result; other
columns are carried along and their names do not matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACE, stage, text_or_empty

MAX_HOT = 4096
MIN_RUN = 256
SPLITTER_CHARS = 32


def normalised(text: Column) -> Column:
    """The text with every run of white space replaced by one blank."""
    return F.regexp_replace(text_or_empty(text), SPACE, " ")


def content_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``row`` (all columns of ``docs``), ``keep_id``,
    ``group_size``, ``kept`` and ``text_sha256``."""
    text = F.col(f"row.`{text_col}`")
    rows = docs.select(F.struct("*").alias("row"))
    hashed = rows.withColumn("norm", normalised(text)).withColumn("h", F.xxhash64("norm"))
    limit = max(MIN_RUN, -(-docs.count() // MAX_HOT))
    # fewer than MAX_HOT rows: each stands for more than rows / MAX_HOT rows
    counted = hashed.groupBy("h").agg(F.count(F.lit(1)).alias("n"))
    hot = F.broadcast(stage(counted.filter(F.col("n") > limit), "hot"))

    ident = F.col(f"row.`{id_col}`")
    salt = F.coalesce(F.pmod(F.xxhash64(ident), F.ceil(F.col("n") / limit)), F.lit(0))
    dealt = (
        hashed.withColumn("prefix", F.substring("norm", 1, SPLITTER_CHARS))
        .join(hot, "h", "left")
        .select("row", "prefix", "h", salt.alias("salt"), F.col("n").isNotNull().alias("hot"))
        .repartitionByRange("prefix", "h", "salt")
        .withColumn("norm", normalised(text))
    )
    run = Window.partitionBy("prefix", "h", "salt", "norm")
    first = run.orderBy(ident.asc_nulls_last())
    runs = dealt.select(
        "row",
        "hot",
        F.row_number().over(first).alias("place"),
        F.first(ident).over(first).alias("run_id"),
        F.count(F.lit(1)).over(run).alias("run_size"),
        F.sha2("norm", 256).alias("text_sha256"),
    )
    whole = F.broadcast(
        hashed.join(hot, "h", "left_semi")
        .groupBy("norm")
        .agg(F.min(ident).alias("group_id"), F.count(F.lit(1)).alias("n"))
        .select(
            F.coalesce(F.sha2("norm", 256), F.lit("")).alias("text_sha256"), "group_id", "n", F.lit(True).alias("hot")
        )
    )
    keep_id = F.when(F.col("n").isNull(), F.col("run_id")).otherwise(F.col("group_id"))
    return runs.join(whole, ["text_sha256", "hot"], "left").select(
        "row",
        keep_id.alias("keep_id"),
        F.coalesce("n", "run_size").alias("group_size"),
        ((F.col("place") == 1) & F.col("run_id").eqNullSafe(keep_id)).alias("kept"),
        "text_sha256",
    )


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: its identifier, ``keep_id`` (the identifier of the
    row that stays), ``group_size``, ``kept`` and ``text_sha256``."""
    runs = content_runs(docs.select(id_col, text_col), id_col, text_col)
    return runs.select(F.col(f"row.`{id_col}`").alias(id_col), "keep_id", "group_size", "kept", "text_sha256")


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row for each text."""
    return content_runs(docs, id_col, text_col).filter("kept").select("row.*")
