"""Missing-value audits.

Every audit is one pass: all counts share one aggregate, each task sends one
row of counts, and the long forms unpivot the single result row.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scrubline.functions.convert import is_non_numeric, percentage
from scrubline.functions.missing import AUDIT, Missing, count_where, is_missing, named

ROWS = "__rows"


def table_shape(df: DataFrame) -> DataFrame:
    """One row: number of rows and of columns."""
    return df.agg(F.count("*").alias("rows")).select(
        "rows", F.lit(len(df.columns)).cast("bigint").alias("columns")
    )


def _unpivot(wide: DataFrame, names: Iterable[str], value: str) -> DataFrame:
    return wide.unpivot(ROWS, list(names), "column", value)


def _chosen(df: DataFrame, columns: Iterable[str] | None) -> list[str]:
    """The columns of an audit: all unless given; none at all is an error."""
    names = list(df.columns if columns is None else columns)
    if not names:
        raise ValueError("no columns to audit")
    return names


def missing_wide(
    df: DataFrame, columns: Iterable[str] | None = None, rule: Missing = AUDIT
) -> DataFrame:
    """One row with one missing count per column."""
    return df.agg(
        *(count_where(is_missing(df, c, rule)).alias(c) for c in _chosen(df, columns))
    )


def missing_counts(df: DataFrame, rules: Mapping[str, Missing]) -> DataFrame:
    """One row: ``rows`` and, for each column under its own rule, ``<column>_missing``."""
    return df.agg(
        F.count("*").alias("rows"),
        *(count_where(is_missing(df, c, r)).alias(f"{c}_missing") for c, r in rules.items()),
    )


def _counted(df: DataFrame, rules: Mapping[str, Missing]) -> DataFrame:
    wide = df.agg(
        F.count("*").alias(ROWS),
        *(count_where(is_missing(df, c, r)).alias(c) for c, r in rules.items()),
    )
    return _unpivot(wide, rules, "missing")


def missing_long(
    df: DataFrame, columns: Iterable[str] | None = None, rule: Missing = AUDIT
) -> DataFrame:
    """(column, missing_count), one row per column."""
    counted = _counted(df, {c: rule for c in _chosen(df, columns)})
    return counted.select("column", F.col("missing").alias("missing_count"))


def missing_percentages(
    df: DataFrame, columns: Iterable[str] | None = None, rule: Missing = AUDIT
) -> DataFrame:
    """(column, missing, pct) over the rows of ``df``; 0 % for an empty table."""
    counted = _counted(df, {c: rule for c in _chosen(df, columns)})
    return counted.select(
        "column", "missing", percentage(F.col("missing"), F.col(ROWS)).alias("pct")
    )


def missing_report(df: DataFrame, column: str, rule: Missing) -> DataFrame:
    """One row for one column: rows, missing, pct."""
    return _counted(df, {column: rule}).select(
        F.col(ROWS).alias("rows"),
        "missing",
        percentage(F.col("missing"), F.col(ROWS)).alias("pct"),
    )


def impute_report(df: DataFrame, model) -> DataFrame:
    """(column, before, after, pct_before) for every column ``model`` fills.

    Each imputed column is computed next to its original, so before and after
    come from the same single pass.
    """
    after = {fill.column: f"__after_{fill.column}" for fill in model.fills}
    both = df.select(
        *(named(c) for c in after), *(model.filled(df, c).alias(a) for c, a in after.items())
    )
    counts = []
    for fill in model.fills:
        before = count_where(is_missing(both, fill.column, fill.missing))
        left = count_where(is_missing(both, after[fill.column], fill.missing))
        counts.append(F.struct(before.alias("before"), left.alias("after")).alias(fill.column))
    wide = both.agg(F.count("*").alias(ROWS), *counts)
    return _unpivot(wide, after, "n").select(
        "column",
        F.col("n.before").alias("before"),
        F.col("n.after").alias("after"),
        percentage(F.col("n.before"), F.col(ROWS)).alias("pct_before"),
    )


def non_numeric_counts(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """(column, non_numeric): present values that are not numbers."""
    columns = list(columns)
    wide = df.agg(
        F.count("*").alias(ROWS),
        *(count_where(is_non_numeric(named(c))).alias(c) for c in columns),
    )
    return _unpivot(wide, columns, "non_numeric").select("column", "non_numeric")


def missing_per_row(df: DataFrame, rules: Mapping[str, Missing]) -> Column:
    """Number of the columns in ``rules`` that are missing in a row."""
    return reduce(add, (is_missing(df, c, r).cast("int") for c, r in rules.items()))


def row_missing_profile(df: DataFrame, rules: Mapping[str, Missing]) -> DataFrame:
    """(n_missing, n): rows by number of missing columns."""
    return (
        df.groupBy(missing_per_row(df, rules).cast("bigint").alias("n_missing"))
        .agg(F.count("*").alias("n"))
        .orderBy("n_missing")
    )
