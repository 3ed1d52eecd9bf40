"""Text lengths, labels and word counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scrubline.functions.missing import named
from scrubline.functions.text import (
    clean_length,
    clean_length_between,
    normalize_label,
    words,
)


def length_distribution(df: DataFrame, column: str) -> DataFrame:
    """(length, n): rows by length of the cleaned text, shortest first."""
    length = clean_length(named(column)).cast("bigint")
    return (
        df.groupBy(length.alias("length")).agg(F.count("*").alias("n")).orderBy("length")
    )


def length_histogram(
    df: DataFrame, column: str, least: int = 1, most: int = 10
) -> DataFrame:
    """:func:`length_distribution` between two lengths.

    The bounds are tested on the raw text, so only the short texts are cleaned.
    """
    short = df.where(clean_length_between(named(column), least, most))
    return length_distribution(short, column)


def with_label(df: DataFrame, column: str, label: str) -> DataFrame:
    """Rows whose label equals ``label``, padding and letter case aside."""
    return df.where(normalize_label(named(column)) == label)


def word_counts(df: DataFrame, column: str) -> DataFrame:
    """(word, n) over raw or cleaned text.

    Words are counted before the shuffle, so a frequent word is one row per
    task.
    """
    return (
        df.select(F.explode_outer(words(named(column))).alias("word"))
        .where(F.col("word") != "")
        .groupBy("word")
        .agg(F.count("*").alias("n"))
    )


def top_words(df: DataFrame, column: str, n: int = 20) -> DataFrame:
    """The ``n`` most frequent words, ties in alphabetical order."""
    return word_counts(df, column).orderBy(F.desc("n"), F.asc("word")).limit(n)
