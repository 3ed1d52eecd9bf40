"""What counts as missing.

The meaning differs by column and by step: an empty label is missing, an empty
version text may not be.  A :class:`Missing` rule states it, and
:func:`is_missing` turns rule and column type into one predicate that is never
NULL itself, so it can be negated and counted safely.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: the texts that a cast to double reads as NaN (any letter case
# unsigned, exact case signed, padded by characters up to the space).
NAN_TEXT = r"^[\x00-\x20]*(?:(?i:nan)|[+-]NaN)[\x00-\x20]*\z"


@dataclass(frozen=True)
class Missing:
    """NULL is always missing; the flags and the domain add to it.

    ``nan``: NaN, or text that reads as NaN.  ``empty``: the text ``''``.
    ``blank``: text of spaces only, ``''`` included.  ``allowed``: any value
    outside these.  Flags that cannot apply to a column's type are ignored.
    """

    nan: bool = False
    empty: bool = False
    blank: bool = False
    allowed: tuple = ()


NULL = Missing()
NAN = Missing(nan=True)
EMPTY = Missing(empty=True)
BLANK = Missing(blank=True)
AUDIT = Missing(nan=True, empty=True)


def named(name: str) -> Column:
    """Column by its exact name, dots and spaces included."""
    return F.col("`" + name.replace("`", "``") + "`")


def count_where(condition: Column) -> Column:
    """Aggregate: rows for which ``condition`` is true.

    Spark generates one small method for each of these.  ``count_if`` instead
    computes all conditions in one method ahead of the aggregate, which a wide
    audit makes too long for the JVM to compile.
    """
    return F.count(F.when(condition, F.lit(1)))


def is_nan_text(column: Column) -> Column:
    """True for text that casts to NaN.

    Same answer as ``isnan(try_cast(column AS DOUBLE))``, without an exception
    inside the cast for each ordinary word.  Such a text starts with padding, a
    sign or an n, and comparing bytes tells most others apart at once.
    """
    possible = (column < ".") | column.startswith("n") | column.startswith("N")
    return possible & column.rlike(NAN_TEXT)


def is_missing(df: DataFrame, name: str, rule: Missing = AUDIT) -> Column:
    """Predicate for column ``name`` of ``df`` under ``rule``."""
    column, dtype = named(name), df.schema[name].dataType
    missing = column.isNull()
    if rule.nan and isinstance(dtype, (T.DoubleType, T.FloatType)):
        missing = missing | F.isnan(column)
    if isinstance(dtype, (T.StringType, T.CharType, T.VarcharType)):
        if rule.nan:
            missing = missing | is_nan_text(column)
        if rule.blank:
            missing = missing | (F.trim(column) == "")
        elif rule.empty:
            missing = missing | (column == "")
    if rule.allowed:
        missing = missing | ~column.isin(*rule.allowed)
    return missing


def is_finite(number: Column) -> Column:
    """True for a floating-point number that is neither NULL, NaN nor infinite."""
    return F.coalesce(F.abs(number) < float("inf"), F.lit(False))


def nan_to_null(df: DataFrame, *names: str) -> DataFrame:
    """NaN, or text that reads as NaN, becomes NULL in the named columns.

    Without names, in every floating-point column.
    """
    names = names or tuple(
        f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))
    )
    return df.withColumns(
        {n: F.when(~is_missing(df, n, NAN), named(n)) for n in names}
    )
