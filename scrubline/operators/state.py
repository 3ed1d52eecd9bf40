"""Fits that take in new rows without reading the old ones again.

A state has one row for each column and different value of a batch, with its number of
rows, and one for its gaps.  States add up, so modes, medians, means and gap counts of all
rows follow from the states of their batches.  A batch is kept in a folder of its own:
writing it again replaces it, so a repeated batch does not count twice.

Meant for columns whose different values are far fewer than their rows.  A state is as
large as the different values of its batch; nothing of it comes to the driver but a
bounded number of counts.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scrubline.functions.missing import NAN, Missing, is_missing, named
from scrubline.operators.impute import Fill, ImputeModel

SCHEMA = "column string, value string, number double, n bigint"
STEPS, SMALL = 1000, 50_000


def column_state(
    df: DataFrame, rules: Mapping[str, Missing], numbers: Iterable[str] = ()
) -> DataFrame:
    """(column, value, number, n) of all rows: texts of the columns in ``rules``, numbers of
    ``numbers``.  Both are NULL for a column's gaps."""
    cells: list[Column] = []
    for c, rule in rules.items():
        text = F.when(~is_missing(df, c, rule), named(c).cast("string"))
        cells += [F.lit(c), text, F.lit(None).cast("double")]
    for c in numbers:
        value = named(c).try_cast("double")
        cells += [F.lit(c), F.lit(None).cast("string"), F.when(~F.isnan(value), value)]
    if not cells:
        raise ValueError("no columns to keep")
    rows = df.select(F.stack(F.lit(len(cells) // 3), *cells).alias("column", "value", "number"))
    return rows.groupBy("column", "value", "number").agg(F.count("*").alias("n"))


def write_batch(state: DataFrame, path: str, batch: str) -> None:
    """Keep the state of one batch below ``path``, replacing that of the same name."""
    if not batch or not all(c.isalnum() or c in "-_." for c in batch) or batch.startswith("."):
        raise ValueError(f"batch name {batch!r}")
    state.write.mode("overwrite").parquet(f"{path}/batch={batch}")


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    """The states of all batches, with their names in ``batch``."""
    schema = T.StructType([*T.StructType.fromDDL(SCHEMA).fields, T.StructField("batch", T.StringType())])
    return spark.read.schema(schema).parquet(path)


def merged(state: DataFrame) -> DataFrame:
    """One state of all batches."""
    return state.groupBy("column", "value", "number").agg(F.sum("n").alias("n"))


def gap_counts(state: DataFrame) -> DataFrame:
    """(column, rows, missing) over all batches."""
    gap = F.col("value").isNull() & F.col("number").isNull()
    missing = F.sum(F.when(gap, F.col("n")).otherwise(0))
    return state.groupBy("column").agg(F.sum("n").alias("rows"), missing.alias("missing"))


def _weighted_quantile(values: DataFrame, q: float) -> float | None:
    """The smallest ``number`` whose share of ``n`` reaches ``q``.

    Each pass narrows the range of the numbers by a thousand, until the rest is small.
    """
    low, high, total, count = values.agg(F.min("number"), F.max("number"), F.sum("n"), F.count("*")).first()
    if not count:
        return None
    rank, before, part = max(1, -int(-q * total // 1)), 0, values
    while count > SMALL and low < high:
        # halves, so that the width of a wide range is a number too
        width = (high / 2 - low / 2) / STEPS
        step = F.least(F.floor((F.col("number") / 2 - low / 2) / width), F.lit(STEPS - 1)) if width else F.lit(0)
        cells = part.groupBy(step.alias("step")).agg(
            F.sum("n").alias("n"), F.count("*").alias("count"), F.min("number").alias("low"), F.max("number").alias("high")
        )
        for cell in sorted(cells.collect(), key=lambda r: r["step"]):
            if rank <= before + cell["n"]:
                low, high, count = cell["low"], cell["high"], cell["count"]
                break
            before += cell["n"]
        part = values.where((F.col("number") >= low) & (F.col("number") <= high))
    for r in sorted(part.collect()):
        before += r["n"]
        if rank <= before:
            return r["number"]
    return None


def fit_from_state(
    state: DataFrame,
    rules: Mapping[str, Missing],
    medians: Iterable[str] = (),
    types: Mapping[str, T.DataType] | None = None,
) -> ImputeModel:
    """Medians, and modes of the columns in ``rules``, over all batches.

    ``types`` are those of columns that are not text: ties go to the smallest value as its
    type has it.
    """
    total, types = merged(state), types or {}
    fills = []
    for c in medians:
        values = total.where((F.col("column") == c) & F.col("number").isNotNull()).select("number", "n")
        fills.append(Fill(c, "median", _weighted_quantile(values, 0.5), NAN))
    if rules:

        def best(i: int, c: str) -> Column:
            value = F.col("value").cast(types.get(c, T.StringType()))
            present = (F.col("column") == c) & F.col("value").isNotNull()
            return F.min(F.when(present, F.struct((-F.col("n")).alias("down"), value.alias("value")))).alias(f"m{i}")

        row = total.agg(*(best(i, c) for i, c in enumerate(rules))).first()
        fills += [
            Fill(c, "mode", row[f"m{i}"]["value"] if row[f"m{i}"] else None, rule)
            for i, (c, rule) in enumerate(rules.items())
        ]
    return ImputeModel(tuple(fills))
