"""Row and domain checks."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scrubline.functions.missing import (
    NAN,
    Missing,
    count_where,
    is_finite,
    is_missing,
    named,
)


@dataclass(frozen=True)
class Domain:
    """Valid values: a closed set, or a closed range of numbers.

    Missing values (NULL, and those of ``missing``) are not violations.  In a
    text column a range compares the number that a text reads as; a text that
    is no number violates it.
    """

    allowed: tuple = ()
    low: float | None = None
    high: float | None = None
    missing: Missing = NAN

    def violated(self, df: DataFrame, column: str) -> Column:
        """Predicate for present values outside the domain; never NULL."""
        value = named(column)
        outside = ~value.isin(*self.allowed) if self.allowed else F.lit(False)
        if self.low is not None or self.high is not None:
            number = value
            if isinstance(df.schema[column].dataType, (T.StringType, T.CharType, T.VarcharType)):
                number = value.try_cast("double")
                outside = outside | number.isNull()
            if self.low is not None:
                outside = outside | F.coalesce(number < self.low, F.lit(False))
            if self.high is not None:
                outside = outside | F.coalesce(number > self.high, F.lit(False))
        return ~is_missing(df, column, self.missing) & outside


def domain_violations(df: DataFrame, domains: Mapping[str, Domain]) -> DataFrame:
    """(column, violations), one row per column, from one pass."""
    wide = df.agg(
        F.count("*").alias("__rows"),
        *(count_where(d.violated(df, c)).alias(c) for c, d in domains.items()),
    )
    return wide.unpivot("__rows", list(domains), "column", "violations").select(
        "column", "violations"
    )


def null_out_of_domain(df: DataFrame, domains: Mapping[str, Domain]) -> DataFrame:
    """Values outside their domain become NULL."""
    return df.withColumns(
        {c: F.when(~d.violated(df, c), named(c)) for c, d in domains.items()}
    )


def complete_rows(df: DataFrame, rules: Mapping[str, Missing]) -> DataFrame:
    """Rows without a missing value in the columns of ``rules``: all, if there are none."""
    present = (~is_missing(df, c, r) for c, r in rules.items())
    return df.where(reduce(and_, present, F.lit(True)))


def incomplete_rows(df: DataFrame, rules: Mapping[str, Missing]) -> DataFrame:
    """The other rows: at least one of the columns is missing."""
    missing = (is_missing(df, c, r) for c, r in rules.items())
    return df.where(reduce(or_, missing, F.lit(False)))


def valid_scores(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Rows whose score columns all hold finite numbers: no NULL, NaN or infinity."""
    return df.where(reduce(and_, (is_finite(named(c).try_cast("double")) for c in columns)))
