"""Dirty text to numbers and dates. Bad text gives NULL, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters kept in counts and in amounts, and the date format.
NOT_A_DIGIT = "[^0-9]"
NOT_IN_AMOUNT = "[^0-9.,]"
LONG_DATE = "MMMM d, yyyy"
INT_MAX = 2_147_483_647
MONTHS = (
    "january", "february", "march", "april", "may", "june", "july", "august",
    "september", "october", "november", "december",
)
# Texts that can be a long date, and days that no year has.
POSSIBLE_DATE = rf"^(?i:{'|'.join(MONTHS)}) [0-9]+, [+-]?[0-9]+\z"
NO_DATE = r"^(?i:february 3[01]|(?:april|june|september|november) 31),"


def to_double(column: Column) -> Column:
    """Number as double; text that is not a number gives NULL."""
    return column.try_cast("double")


def to_score(column: Column) -> Column:
    """Number text as 32-bit float; ``'nan'`` gives NaN."""
    return column.try_cast("float")


def digits_to_integer(column: Column, dtype: str = "int") -> Column:
    """Drop all but digits and read the rest as an integer.

    ``'1,000+'`` gives 1000; a value beyond ``dtype`` (``'int'`` or
    ``'bigint'``) gives NULL.  Signs, decimal points and suffixes are dropped
    too: ``'3.0M'`` gives 30.
    """
    digits = F.regexp_replace(column.cast("string"), NOT_A_DIGIT, "")
    # A cast that fails raises and catches an exception for each row, so empty
    # texts are set aside and the range is tested on the wider type.
    number = F.nullif(digits, F.lit("")).try_cast("bigint")
    if dtype == "bigint":
        return number
    too_large = F.lit(INT_MAX + 1)
    return F.nullif(F.least(number, too_large), too_large).try_cast(dtype)


def amount_to_double(column: Column) -> Column:
    """Money text as double: ``'$4.99'`` and ``'4,99'`` give 4.99.

    The comma is a decimal mark, so ``'1,234.56'`` has two and gives NULL.
    """
    kept = F.regexp_replace(column.cast("string"), NOT_IN_AMOUNT, "")
    # An empty rest would cost an exception inside the cast.
    return F.nullif(F.translate(kept, ",", "."), F.lit("")).try_cast("double")


def long_date(column: Column) -> Column:
    """``'January 7, 2018'`` as a date.

    A text that cannot be one would cost an exception inside the parser, so nearly all of these are
    told apart before.
    """
    possible = column.rlike(POSSIBLE_DATE) & ~column.rlike(NO_DATE)
    return F.try_to_date(F.when(possible, column), LONG_DATE)


def is_non_numeric(column: Column) -> Column:
    """True for a present value that is not a number; never NULL."""
    return column.isNotNull() & column.try_cast("double").isNull()


def percentage(part: Column, whole: Column) -> Column:
    """``100 * part / whole`` with two decimals, an exact half going up; 0 when
    ``whole`` is 0."""
    share = F.round(F.try_divide(100.0 * part, whole), 2)
    return F.coalesce(share, F.lit(0.0))
