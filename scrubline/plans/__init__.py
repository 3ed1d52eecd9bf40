"""Whole flows: ingest, clean, load."""

from scrubline.plans.apps import (
    APP_DOMAINS,
    APP_MISSING,
    clean_apps,
    convert_apps,
    fit_apps,
    impute_all,
)
from scrubline.plans.ingest import land_csv
from scrubline.plans.load import load_tables, load_tables_once
from scrubline.plans.reviews import (
    CRITICAL,
    SCORES,
    clean_reviews,
    complete_reviews,
    impute_mean_rating,
    positive_texts,
    scored,
    top_positive_words,
    with_clean_text,
)
from scrubline.plans.whole import prepare

__all__ = [
    "APP_DOMAINS",
    "APP_MISSING",
    "CRITICAL",
    "SCORES",
    "clean_apps",
    "clean_reviews",
    "complete_reviews",
    "convert_apps",
    "fit_apps",
    "impute_all",
    "impute_mean_rating",
    "land_csv",
    "load_tables",
    "load_tables_once",
    "positive_texts",
    "prepare",
    "scored",
    "top_positive_words",
    "with_clean_text",
]
