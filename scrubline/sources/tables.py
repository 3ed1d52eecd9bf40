"""The two input tables."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import types as T

# The headers of the two inputs, in file order.
APP_HEADERS = (
    "App",
    "Category",
    "Rating",
    "Reviews",
    "Size",
    "Installs",
    "Type",
    "Price",
    "Content Rating",
    "Genres",
    "Last Updated",
    "Current Ver",
    "Android Ver",
)
REVIEW_HEADERS = (
    "App",
    "Translated_Review",
    "Sentiment",
    "Sentiment_Polarity",
    "Sentiment_Subjectivity",
)


def text_schema(headers: Iterable[str]) -> T.StructType:
    """All columns as text; types come later, by conversions that cannot fail."""
    return T.StructType([T.StructField(h, T.StringType()) for h in headers])
