"""Cleaning of the review table and the words of positive reviews."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scrubline.functions.convert import to_score
from scrubline.functions.missing import EMPTY, NULL, named
from scrubline.functions.text import clean_text, has_clean_length, normalize_label
from scrubline.operators.impute import fit_mean
from scrubline.operators.quality import complete_rows
from scrubline.operators.words import top_words, with_label

TEXT = "translated_review"

# The columns a review must have, the scores, the least length.
CRITICAL = {
    "translated_review": EMPTY,
    "sentiment": NULL,
    "sentiment_polarity": NULL,
    "sentiment_subjectivity": NULL,
}
SCORES = ("sentiment_polarity", "sentiment_subjectivity")
LEAST_LENGTH = 3


def complete_reviews(df: DataFrame) -> DataFrame:
    """Reviews with a text, a label and both scores."""
    return complete_rows(df, CRITICAL)


def impute_mean_rating(df: DataFrame) -> DataFrame:
    """Fill ``rating`` by its mean if the table has such a column."""
    if "rating" not in df.columns:
        return df
    return fit_mean(df, "rating").transform(df)


def scored(df: DataFrame) -> DataFrame:
    """Scores as 32-bit floats."""
    return df.withColumns({c: to_score(named(c)) for c in SCORES})


def with_clean_text(df: DataFrame) -> DataFrame:
    """The review text cleaned in place."""
    return df.withColumn(TEXT, clean_text(named(TEXT)))


def clean_reviews(df: DataFrame, least: int = LEAST_LENGTH) -> DataFrame:
    """Complete reviews of at least ``least`` cleaned characters.

    Scores become floats and the text is cleaned; ``review_length`` and
    ``sentiment_normalized`` are added.  The length is tested on the raw text
    ahead of the cleaning, which then runs once, on the rows that stay.
    """
    complete = impute_mean_rating(complete_reviews(df))
    long_enough = complete.where(has_clean_length(named(TEXT), least))
    cleaned = with_clean_text(scored(long_enough))
    return cleaned.withColumns(
        {
            "review_length": F.length(named(TEXT)),
            "sentiment_normalized": normalize_label(named("sentiment")),
        }
    )


def positive_texts(df: DataFrame, least: int = LEAST_LENGTH) -> DataFrame:
    """Raw texts of the positive reviews among :func:`clean_reviews`.

    Words are the same in the raw and in the cleaned text, so the text is
    rewritten only once, while splitting it.
    """
    positive = with_label(complete_reviews(df), "sentiment", "positive")
    return positive.where(has_clean_length(named(TEXT), least)).select(TEXT)


def top_positive_words(df: DataFrame, n: int = 20) -> DataFrame:
    """The most frequent words of positive reviews: (word, n)."""
    return top_words(positive_texts(df), TEXT, n)
