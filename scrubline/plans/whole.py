"""Everything in one go: ingest, profile, clean, load."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scrubline.functions.convert import percentage
from scrubline.functions.missing import AUDIT, count_where, is_missing
from scrubline.operators.audit import ROWS
from scrubline.operators.impute import ImputeModel
from scrubline.operators.observed import (
    Counts,
    count_table,
    is_complete,
    missing_parts,
    non_numeric_parts,
    observed_snapshot,
)
from scrubline.operators.stats import value_distribution
from scrubline.operators.words import length_histogram
from scrubline.plans.apps import APP_DOMAINS, clean_apps, fit_apps, typed_rating
from scrubline.plans.ingest import land_csv
from scrubline.plans.load import load_tables
from scrubline.plans.reviews import (
    CRITICAL,
    SCORES,
    TEXT,
    clean_reviews,
    complete_reviews,
    top_positive_words,
)
from scrubline.sources.csv import malformed_rows
from scrubline.sources.jdbc import JdbcTarget
from scrubline.sources.parquet import write_snapshot
from scrubline.sources.tables import APP_HEADERS, REVIEW_HEADERS, text_schema


def _app_parts(apps: DataFrame, model: ImputeModel) -> tuple[DataFrame, dict[str, Column]]:
    """The typed apps with each imputed column next to its original, and what the reports
    count there."""
    after = {f.column: f"__after_{f.column}" for f in model.fills}
    both = apps.withColumns({a: model.filled(apps, c) for c, a in after.items()})
    parts = {}
    for fill in model.fills:
        parts[f"before {fill.column}"] = count_where(is_missing(apps, fill.column, fill.missing))
        parts[f"after {fill.column}"] = count_where(is_missing(both, after[fill.column], fill.missing))
    for c in apps.columns:
        parts[f"missing {c}"] = count_where(is_missing(both, after.get(c, c), AUDIT))
    for c, domain in APP_DOMAINS.items():
        parts[f"outside {c}"] = count_where(domain.violated(apps, c))
    return both, parts


def _review_parts(reviews: DataFrame) -> dict[str, Column]:
    """What the reports count over the raw reviews."""
    complete = is_complete(reviews, CRITICAL)
    return (
        {"complete": count_where(complete)}
        | missing_parts(reviews, reviews.columns, "missing ")
        | missing_parts(reviews, reviews.columns, "complete missing ", where=complete)
        | non_numeric_parts(SCORES, "non-numeric ", complete)
    )


def _count_reports(apps: DataFrame, reviews: DataFrame, model: ImputeModel, a: Counts, r: Counts) -> list[tuple]:
    """(report, column, n, before, rows) of all reports that are counts."""
    found = [("app_shape", None, len(apps.columns), None, a[ROWS]), ("review_shape", None, len(reviews.columns), None, r[ROWS])]
    found += [("app_imputation", f.column, a[f"after {f.column}"], a[f"before {f.column}"], a[ROWS]) for f in model.fills]
    found += [("app_domain_violations", c, a[f"outside {c}"], None, a[ROWS]) for c in APP_DOMAINS]
    found += [("app_missing", c, a[f"missing {c}"], None, a[ROWS]) for c in apps.columns]
    found += [("review_missing", c, r[f"missing {c}"], None, r[ROWS]) for c in reviews.columns]
    found += [("complete_review_missing", c, r[f"complete missing {c}"], None, r["complete"]) for c in reviews.columns]
    return found + [("review_non_numeric", c, r[f"non-numeric {c}"], None, r["complete"]) for c in SCORES]


def _shown(counts: DataFrame) -> dict[str, DataFrame]:
    """Each report of the stored counts with its own columns."""
    n, rows = F.col("n"), F.col("rows")
    pct = percentage(n, rows).alias("pct")
    columns = {
        "app_shape": ["rows", n.alias("columns")],
        "review_shape": ["rows", n.alias("columns")],
        "app_imputation": ["column", "before", n.alias("after"), percentage(F.col("before"), rows).alias("pct_before")],
        "app_domain_violations": ["column", n.alias("violations")],
        "app_missing": ["column", n.alias("missing_count")],
        "review_missing": ["column", n.alias("missing"), pct],
        "complete_review_missing": ["column", n.alias("missing"), pct],
        "review_non_numeric": ["column", n.alias("non_numeric")],
    }
    return {name: counts.where(F.col("report") == name).select(*shown) for name, shown in columns.items()}


def prepare(
    spark: SparkSession,
    app_paths: str | list[str],
    review_paths: str | list[str],
    out: str,
    target: JdbcTarget | None = None,
    relative_error: float | None = None,
    multi_line: bool = True,
) -> dict[str, DataFrame]:
    """Clean both tables into ``out`` and return them with the reports on them.

    ``out`` gets ``raw`` and ``clean`` snapshots, and ``reports`` with every
    report as parquet, whole.  Those that count are one table, ``reports/counts``, and are
    counted while the snapshots are written; the others read them.  Rows with too many
    or too few fields are also kept raw, in ``raw/malformed_apps`` and
    ``raw/malformed_reviews``.  With a ``target`` the cleaned tables are loaded
    there as ``apps`` and ``reviews``, by way of ``loads``.
    """
    apps = land_csv(spark, app_paths, f"{out}/raw/apps", APP_HEADERS, multi_line)
    reviews = land_csv(spark, review_paths, f"{out}/raw/reviews", REVIEW_HEADERS, multi_line)
    apps = typed_rating(apps)
    model = fit_apps(apps, relative_error)
    # all counts are made while the cleaned tables are written, which takes no shuffle
    both, parts = _app_parts(apps, model)
    clean_app, app_counts = observed_snapshot(
        both, f"{out}/clean/apps", parts, lambda df: clean_apps(df.select(apps.columns), model), narrow=True
    )
    clean_review, review_counts = observed_snapshot(
        reviews, f"{out}/clean/reviews", _review_parts(reviews), clean_reviews, narrow=True
    )
    clean = {"apps": clean_app, "reviews": clean_review}
    if target:
        load_tables(clean, target, f"{out}/loads")
    complete = complete_reviews(reviews)
    app_schema, review_schema = text_schema(APP_HEADERS), text_schema(REVIEW_HEADERS)
    malformed = {
        "malformed_apps": malformed_rows(
            spark, app_paths, app_schema, f"{out}/raw/malformed_apps", multi_line
        ),
        "malformed_reviews": malformed_rows(
            spark, review_paths, review_schema, f"{out}/raw/malformed_reviews", multi_line
        ),
    }
    rows = _count_reports(apps, reviews, model, app_counts, review_counts)
    counts = count_table(spark, rows, "report string, column string, n bigint, before bigint, rows bigint")
    reports = {
        "app_fill_values": model.as_frame(spark),
        "app_types": value_distribution(clean["apps"], "type"),
        "review_lengths": length_histogram(complete, TEXT),
        "positive_words": top_positive_words(reviews),
    }
    stored = {
        name: write_snapshot(report, f"{out}/reports/{name}") for name, report in reports.items()
    }
    stored |= _shown(write_snapshot(counts, f"{out}/reports/counts"))
    return clean | malformed | stored
