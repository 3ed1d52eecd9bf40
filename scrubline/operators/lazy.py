"""Statistics as scalar subqueries, so that a fit is part of the plan it fills.

An eager fit runs jobs and keeps literals.  These are columns instead: a transform with
them runs nothing until its result is asked for, follows its table when that changes, and
can be held by a view.  Equal subqueries of one plan run once.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scrubline.functions.missing import NAN, Missing, count_where, is_missing, named
from scrubline.operators.quantiles import ERROR, SIZE
from scrubline.operators.stats import modes_row


def lazy_modes(df: DataFrame, rules: Mapping[str, Missing]) -> dict[str, Column]:
    """The most frequent value of each column, all from one subquery."""
    row = modes_row(df, rules).select(F.struct(*(named(c) for c in rules)).alias("modes")).scalar()
    return {c: row.getField(c).getField("value") for c in rules}


def lazy_mean(df: DataFrame, column: str) -> Column:
    """The average without NULL and NaN.  Its last digits depend on the partitioning."""
    present = F.when(~is_missing(df, column, NAN), named(column).try_cast("double"))
    return df.select(F.avg(present)).scalar()


def lazy_quantile(df: DataFrame, column: str, q: float = 0.5) -> Column:
    """The smallest element whose cumulative share reaches ``q``, exactly.

    A sketch brackets it, and the values within the bracket are counted: a few
    thousandths of the rows, added up by value.  The counts must show the rank inside;
    a sketch that is wrong (about once in a million) is an error, not a wrong value.
    """
    number = named(column).try_cast("double")
    values = df.select(F.when(~F.isnan(number), number).alias("v")).where("v is not null")
    # partition numbers are not allowed in a subquery, so one task merges the sketches
    sketch = values.agg(F.count("*").alias("n"), F.kll_sketch_agg_double("v", SIZE).alias("s"))
    ends = [max(0.0, q - 3 * ERROR), min(1.0, q + 3 * ERROR)]
    points = F.kll_sketch_get_quantile_double("s", F.array(*map(F.lit, ends)))
    known = F.when(F.col("n") > 0, F.struct("n", points.alias("p")))
    look = sketch.select(known.alias("look")).scalar()
    low, high = look.getField("p")[0], look.getField("p")[1]
    rank = F.greatest(F.ceil(look.getField("n") * q), F.lit(1))
    # NULL stands for all that is before the bracket
    upper = values.where(F.col("v") <= high).select(F.when(F.col("v") >= low, F.col("v")).alias("v"))
    counts = upper.groupBy("v").agg(F.count("*").alias("n"))
    upto = F.sum("n").over(Window.orderBy(F.asc_nulls_first("v")).rowsBetween(Window.unboundedPreceding, 0))
    ranked = counts.select("v", upto.alias("upto"))
    found = ranked.agg(
        F.min(F.when(F.col("upto") >= rank, F.col("v"))).alias("value"),
        F.max("upto").alias("last"),
        count_where(F.col("v").isNull() & (F.col("upto") >= rank)).alias("early"),
    )
    right = (F.col("early") == 0) & (F.col("last") >= rank)
    wrong = F.raise_error(F.lit("the sketch missed the quantile: fit it eagerly"))
    return found.select(F.when(F.col("last").isNotNull(), F.when(right, F.col("value")).otherwise(wrong.cast("double")))).scalar()
