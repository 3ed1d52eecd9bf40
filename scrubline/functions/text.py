"""Text cleaning, length tests and words.

Word characters are ASCII letters, digits and the underscore.  Cleaned text is
what :func:`strip_punctuation`, then :func:`squeeze_spaces`, then lower case
give.  Every run of other characters ends as exactly one character there: a
lone tab or line break stays, anything else becomes a space.  Two things
follow, and they carry the speed of this module:

* one regular expression can clean a text in one pass, and
* the cleaned length counts word characters plus runs, so a bound on it can be
  tested on the first few characters of the raw text, without cleaning it.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The two rewrites, and their fusion.
PUNCTUATION = r"[^\w\s]"
SPACE_RUN = r"\s{2,}"
PUNCTUATION_OR_RUN = r"\W(?:\W+|(?<!\s))"

# Beyond this many units a regular expression is no longer the cheap test.
MAX_UNITS = 100


def strip_punctuation(column: Column) -> Column:
    """Each character that is neither word character nor white space → space."""
    return F.regexp_replace(column, PUNCTUATION, " ")


def squeeze_spaces(column: Column) -> Column:
    """Each run of two or more white-space characters → one space."""
    return F.regexp_replace(column, SPACE_RUN, " ")


def clean_text(column: Column) -> Column:
    """Punctuation stripped, spaces squeezed, lower case, in one pass."""
    return F.lower(F.regexp_replace(column, PUNCTUATION_OR_RUN, " "))


def clean_length(column: Column) -> Column:
    """``length(clean_text(column))`` by a cheaper rewrite of equal length."""
    return F.length(F.regexp_replace(column, r"\W+", " "))


def has_clean_length(column: Column, least: int) -> Column:
    """``length(clean_text(column)) >= least``, from the raw text.

    The match stops after ``least`` units, so it costs the same on long and
    short texts, and a filter on it does not clean every text a second time.
    """
    if least > MAX_UNITS:
        return clean_length(column) >= least
    return column.rlike(rf"^(?:\w|\W++){{{least}}}")


def clean_length_between(column: Column, least: int, most: int) -> Column:
    """``length(clean_text(column)) BETWEEN least AND most``, from the raw text."""
    return has_clean_length(column, least) & ~has_clean_length(column, most + 1)


def words(column: Column) -> Column:
    """Lower-case words of raw or cleaned text as an array.

    A separator at either end leaves an empty string there; drop those after
    the explode.
    """
    return F.split(F.lower(F.regexp_replace(column, r"\W+", " ")), " ")


def normalize_label(column: Column) -> Column:
    """Trimmed lower-case label."""
    return F.lower(F.trim(column))


def show_text(column: Column, width: int) -> Column:
    """Display form of a long text: cut to ``width`` with three dots at the end.

    A width below four has room for dots only.
    """
    text = column.cast("string")
    cut = F.concat(F.substring(text, 1, max(width - 3, 0)), F.lit("..."[:width]))
    return F.when(F.length(text) > width, cut).otherwise(text)
