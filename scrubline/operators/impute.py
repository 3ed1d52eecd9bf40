"""Missing-value imputation: fit statistics once, apply them as literals.

A ``fit_*`` function runs its Spark jobs and returns an :class:`ImputeModel`
that holds one value per column.  ``transform`` is then a narrow projection
that the optimizer folds into whatever surrounds it.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scrubline.functions.missing import NAN, Missing, count_where, is_missing, named
from scrubline.operators.heavy import bounded_modes
from scrubline.operators.lazy import lazy_mean, lazy_modes, lazy_quantile
from scrubline.operators.means import exact_mean
from scrubline.operators.stats import (
    approximate_quantile,
    exact_quantile,
    look_at,
    modes_row,
)


def _column(value: object) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


@dataclass(frozen=True)
class Fill:
    """One column's fill value, or a column that gives it, and what it replaces."""

    column: str
    statistic: str
    value: object
    missing: Missing


@dataclass(frozen=True)
class ImputeModel:
    """Fill values of several columns, one each; models add up with ``+``."""

    fills: tuple[Fill, ...] = ()

    def __post_init__(self) -> None:
        columns = [f.column for f in self.fills]
        twice = sorted({c for c in columns if columns.count(c) > 1})
        if twice:
            raise ValueError(f"more than one fill for {twice}")

    def __add__(self, other: ImputeModel) -> ImputeModel:
        return ImputeModel(self.fills + other.fills)

    def value(self, column: str) -> object:
        return self._fill(column).value

    def _fill(self, column: str) -> Fill:
        return next(f for f in self.fills if f.column == column)

    def filled(self, df: DataFrame, column: str) -> Column:
        """The imputed column; its gaps are NULL if it had no value to learn from."""
        fill = self._fill(column)
        value = _column(fill.value).cast(df.schema[column].dataType)
        return F.when(is_missing(df, column, fill.missing), value).otherwise(named(column))

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns({f.column: self.filled(df, f.column) for f in self.fills})

    def as_frame(self, spark: SparkSession) -> DataFrame:
        """(column, statistic, value), one row per fill."""
        def text(value: object) -> Column:
            known = value if value is None or isinstance(value, Column) else str(value)
            return _column(known).cast("string")

        names = ("column", "statistic", "value")
        fills = F.array(
            *(F.struct(*(text(v).alias(n) for n, v in zip(names, (f.column, f.statistic, f.value)))) for f in self.fills)
        )
        typed = fills.cast("array<struct<column:string,statistic:string,value:string>>")
        return spark.range(1).select(F.inline(typed))


def fit_median(
    df: DataFrame, column: str, relative_error: float | None = None, lazy: bool = False
) -> ImputeModel:
    """Median of ``column``: exact, or within a rank error in a single pass.

    ``lazy`` here and below runs no job: the value is a subquery of the plan it fills.
    """
    if lazy:
        value = lazy_quantile(df, column, 0.5)
    elif relative_error:
        value = approximate_quantile(df, column, 0.5, relative_error)
    else:
        value = exact_quantile(df, column, 0.5)
    return ImputeModel((Fill(column, "median", value, NAN),))


def fit_mean(df: DataFrame, column: str, lazy: bool = False) -> ImputeModel:
    """Mean of ``column`` without NULL and NaN, the same for any partitioning unless lazy."""
    value = lazy_mean(df, column) if lazy else exact_mean(df, column)
    return ImputeModel((Fill(column, "mean", value, NAN),))


def fit_modes(
    df: DataFrame, rules: Mapping[str, Missing], lazy: bool = False
) -> ImputeModel:
    """Modes of all columns in ``rules`` from one job, each under its own rule."""
    if not rules:
        return ImputeModel()
    if lazy:
        modes = lazy_modes(df, rules)
        return ImputeModel(tuple(Fill(c, "mode", modes[c], rule) for c, rule in rules.items()))
    row = modes_row(df, rules).first()
    return ImputeModel(
        tuple(
            Fill(c, "mode", row[c].value if row[c] else None, rule)
            for c, rule in rules.items()
        )
    )


def fit_bounded_modes(df: DataFrame, rules: Mapping[str, Missing]) -> ImputeModel:
    """:func:`fit_modes` for tables with nearly unique columns, whose values it does not shuffle.

    A few small jobs instead of one; the same values.
    """
    modes = bounded_modes(df, rules) if rules else {}
    return ImputeModel(
        tuple(Fill(c, "mode", m and m.value, rules[c]) for c, m in modes.items())
    )


def _gaps(df: DataFrame, rules: Mapping[str, Missing]) -> dict[str, Column]:
    return {c: count_where(is_missing(df, c, r)) for c, r in rules.items()}


def fit_modes_where_missing(df: DataFrame, rules: Mapping[str, Missing]) -> ImputeModel:
    """Modes of those columns in ``rules`` that have anything to fill.

    A counting pass comes first.  It needs no shuffle, while the mode of a
    nearly unique column shuffles all of it.
    """
    if not rules:
        return ImputeModel()
    gaps = df.agg(*(n.alias(c) for c, n in _gaps(df, rules).items())).first()
    return fit_modes(df, {c: r for c, r in rules.items() if gaps[c]})


def fit_median_and_modes(
    df: DataFrame, median: str, rules: Mapping[str, Missing]
) -> ImputeModel:
    """:func:`fit_median` of one column and :func:`fit_modes_where_missing` of others.

    The gaps are counted in the median's first pass.
    """
    look = look_at(df, median, _gaps(df, rules))
    value = exact_quantile(df, median, 0.5, look=look)
    modes = fit_modes(df, {c: r for c, r in rules.items() if look.counts[c]})
    return ImputeModel((Fill(median, "median", value, NAN),)) + modes
