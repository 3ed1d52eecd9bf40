"""Cleaning of the app table."""

from __future__ import annotations

from contextlib import nullcontext

from pyspark.sql import DataFrame

from scrubline.functions.convert import (
    amount_to_double,
    digits_to_integer,
    long_date,
    to_double,
)
from scrubline.functions.missing import AUDIT, BLANK, NAN, named
from scrubline.operators.impute import (
    ImputeModel,
    fit_median,
    fit_median_and_modes,
    fit_modes,
)
from scrubline.operators.quality import Domain
from scrubline.sources.parquet import persisted

# What is missing in the imputed columns, the valid values, and
# the order of the cleaned columns.
APP_MISSING = {
    "rating": NAN,
    "type": BLANK,
    "content_rating": NAN,
    "current_ver": NAN,
    "android_ver": NAN,
}
APP_DOMAINS = {
    "type": Domain(allowed=("Free", "Paid"), missing=BLANK),
    "rating": Domain(low=0.0, high=5.0),
}
CLEAN_ORDER = (
    "app",
    "category",
    "rating",
    "size",
    "type",
    "content_rating",
    "genres",
    "last_updated",
    "current_ver",
    "android_ver",
    "reviews",
    "installs",
    "price",
    "last_updated_date",
)


def typed_rating(df: DataFrame) -> DataFrame:
    """``rating`` as double."""
    return df.withColumn("rating", to_double(named("rating")))


def fit_apps(
    df: DataFrame, relative_error: float | None = None, keep: bool = False, lazy: bool = False
) -> ImputeModel:
    """Median of the rating and modes of type, content rating and versions.

    ``lazy`` runs no job: the values are subqueries of the plan that uses them.

    ``keep`` holds the five columns between the passes, for a table that is
    costly to read again, such as CSV or the result of a query.
    """
    modes = {c: rule for c, rule in APP_MISSING.items() if c != "rating"}
    narrow = df.select(*(named(c) for c in APP_MISSING))
    if lazy:
        return fit_median(narrow, "rating", lazy=True) + fit_modes(narrow, modes, lazy=True)
    with persisted(narrow) if keep else nullcontext(narrow) as table:
        return fit_median(table, "rating", relative_error) + fit_modes(table, modes)


def convert_apps(df: DataFrame, count_type: str = "int") -> DataFrame:
    """Counts, price and date from text; the date's text stays next to it."""
    return df.withColumns(
        {
            "reviews": digits_to_integer(named("reviews"), count_type),
            "installs": digits_to_integer(named("installs"), count_type),
            "price": amount_to_double(named("price")),
            "last_updated_date": long_date(named("last_updated")),
        }
    )


def clean_apps(
    df: DataFrame,
    model: ImputeModel | None = None,
    relative_error: float | None = None,
    count_type: str = "int",
) -> DataFrame:
    """Impute and convert; extra columns of ``df`` come first.

    Without a ``model`` one is fitted on ``df``, which costs two or three
    passes over five columns.  The result itself is one narrow projection.
    """
    model = model or fit_apps(df, relative_error)
    cleaned = convert_apps(model.transform(typed_rating(df)), count_type)
    extra = [c for c in df.columns if c not in CLEAN_ORDER]
    return cleaned.select(*(named(c) for c in (*extra, *CLEAN_ORDER)))


def impute_all(df: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """Rating by its median, every other column but the keys by its mode.

    NULL, NaN text and empty text are missing everywhere, blank text in
    ``type`` too.
    """
    typed = typed_rating(df)
    rest = [c for c in df.columns if c not in ("rating", *keys)]
    rules = {c: BLANK if c == "type" else AUDIT for c in rest}
    model = fit_median_and_modes(typed, "rating", rules)
    return model.transform(typed)
