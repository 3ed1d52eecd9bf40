"""The registered queries: one per operator or flow, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scrubline import functions as fn
from scrubline import operators as ops
from scrubline import plans, sources
from scrubline.checks import inputs
from scrubline.checks.inputs import CSV_LINE, apps_raw, numbers, reviews_raw
from scrubline.functions.missing import named
from scrubline.operators import state
from scrubline.plans.apps import typed_rating
from scrubline.session import shared_folder

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

MODE_RULES = {c: r for c, r in plans.APP_MISSING.items() if c != "rating"}


def _register(run: Query) -> Query:
    QUERIES[run.__name__] = run
    return run


def _long(df: DataFrame, *names: str) -> DataFrame:
    """Integers as bigint, the common type of both engines."""
    return df.withColumns({n: named(n).cast("bigint") for n in names})


def _plain_scores(df: DataFrame) -> DataFrame:
    """32-bit scores widened, NaN as NULL, for comparison."""
    plain = sources.jdbc_ready(df)
    return plain.withColumns({c: named(c).cast("double") for c in plans.SCORES})


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.top_positive_words(reviews_raw(spark, sf_dir))


# --- sources and sinks -------------------------------------------------------


@_register
def normalize_columns(spark, sf_dir):
    raw = apps_raw(spark, sf_dir).toDF("App-ID", *sources.APP_HEADERS)
    return fn.nan_to_null(sources.normalize_columns(raw), "rating")


@_register
def table_shape(spark, sf_dir):
    apps, reviews = apps_raw(spark, sf_dir), reviews_raw(spark, sf_dir)
    return (
        ops.table_shape(apps)
        .select(F.lit("apps").alias("table_name"), "rows", "columns")
        .unionAll(
            ops.table_shape(reviews).select(
                F.lit("reviews").alias("table_name"), "rows", "columns"
            )
        )
    )


@_register
def csv_roundtrip(spark, sf_dir):
    path = shared_folder(spark, "csv_roundtrip")
    headers = ("Review-ID", *sources.REVIEW_HEADERS)
    sources.write_csv(reviews_raw(spark, sf_dir).toDF(*headers), path)
    back = sources.read_csv(spark, path, sources.text_schema(headers))
    return _long(sources.normalize_columns(back), "review_id")


@_register
def csv_split_roundtrip(spark, sf_dir):
    """As ``csv_roundtrip``, with every file read as lines that are put together."""
    path = shared_folder(spark, "csv_split_roundtrip")
    headers = ("Review-ID", *sources.REVIEW_HEADERS)
    sources.write_csv(reviews_raw(spark, sf_dir).toDF(*headers), path)
    back = sources.read_csv_split(spark, path, sources.text_schema(headers))
    return _long(sources.normalize_columns(back), "review_id")


@_register
def inferred_schema(spark, sf_dir):
    """Types of the apps and of the parts, all read as text."""
    parts = spark.read.parquet(f"{sf_dir}/part.parquet")
    texts = parts.select(*(named(c).cast("string") for c in parts.columns))
    found = [
        ops.inferred_schema(df).select(F.lit(name).alias("table_name"), "column", "type", "reason")
        for name, df in (("apps", apps_raw(spark, sf_dir).drop("app_id", "rating")), ("parts", texts))
    ]
    return found[0].unionAll(found[1])


@_register
def csv_malformed_rows(spark, sf_dir):
    path = shared_folder(spark, "csv_malformed_rows")
    # One unquoted column holds whole lines, so that each file starts with the header.
    lines = numbers(spark, sf_dir).selectExpr(f"{CSV_LINE} AS `key,size,label`")
    lines.write.csv(path, header=True, sep="\x01", quote="")
    schema = sources.text_schema(["key", "size", "label"])
    out = shared_folder(spark, "csv_malformed_rows_table")
    found = sources.malformed_rows(spark, path, schema, out, multi_line=False)
    return _long(found, "key").select("key", "size", "malformed_line")


@_register
def parquet_roundtrip(spark, sf_dir):
    headers = ("App-ID", *sources.APP_HEADERS)
    csv = shared_folder(spark, "parquet_roundtrip_csv")
    sources.write_csv(apps_raw(spark, sf_dir).toDF(*headers), csv)
    landed = plans.land_csv(spark, csv, shared_folder(spark, "parquet_roundtrip"), headers)
    return _long(fn.nan_to_null(typed_rating(landed), "rating"), "app_id")


@_register
def preview_reviews(spark, sf_dir):
    texts = plans.clean_reviews(reviews_raw(spark, sf_dir))
    return ops.preview(texts.select("review_id", "translated_review"), "review_id", 5, 100)


@_register
def preview_ties(spark, sf_dir):
    return ops.preview(apps_raw(spark, sf_dir).select("genres", "category", "app_id"), "genres")


@_register
def jdbc_ready_apps(spark, sf_dir):
    return _shown_apps(sources.jdbc_ready(plans.convert_apps(apps_raw(spark, sf_dir))))


@_register
def jdbc_ready_reviews(spark, sf_dir):
    return _plain_scores(sources.jdbc_ready(plans.scored(reviews_raw(spark, sf_dir))))


def _loaded(staged: DataFrame, name: str) -> DataFrame:
    """What the ledger of a load says in which every file arrives twice."""
    manifest = sources.load_manifest(staged)
    landed = staged.unionAll(staged)
    state = sources.ledger(manifest, sources.landed_files(landed))
    files = state.agg(
        F.sum("sent_rows").alias("n_rows"),
        F.sum("landed_rows").alias("landed_rows"),
        F.every(F.col("state") == "complete").alias("complete"),
    )
    once = sources.each_once(landed, manifest).agg(F.count("*").alias("once_rows"))
    check = manifest.agg(F.sum("checksum").alias("checksum"))
    parts = files.unionByName(once, allowMissingColumns=True).unionByName(check, allowMissingColumns=True)
    return parts.agg(*(F.max(c).alias(c) for c in parts.columns)).select(F.lit(name).alias("table_name"), "*")


@_register
def load_manifest(spark, sf_dir):
    """Both cleaned tables, staged for a load: rows and checksums, copies told apart."""
    tables = {
        "apps": plans.clean_apps(apps_raw(spark, sf_dir)),
        "reviews": plans.clean_reviews(reviews_raw(spark, sf_dir)),
    }
    found = [
        _loaded(sources.stage_files(sources.jdbc_ready(df), shared_folder(spark, f"load_{name}")), name)
        for name, df in tables.items()
    ]
    return found[0].unionAll(found[1])


# --- filters -------------------------------------------------------------------


@_register
def type_missing_report(spark, sf_dir):
    return ops.missing_report(apps_raw(spark, sf_dir), "type", fn.BLANK)


@_register
def reviews_complete(spark, sf_dir):
    return plans.complete_reviews(reviews_raw(spark, sf_dir))


@_register
def reviews_incomplete_sample(spark, sf_dir):
    rows = ops.incomplete_rows(reviews_raw(spark, sf_dir), plans.CRITICAL)
    return ops.preview(rows.select("review_id", *plans.CRITICAL), "review_id")


@_register
def non_numeric_counts(spark, sf_dir):
    return ops.non_numeric_counts(
        plans.complete_reviews(reviews_raw(spark, sf_dir)), plans.SCORES
    )


@_register
def reviews_min_length(spark, sf_dir):
    cleaned = plans.clean_reviews(reviews_raw(spark, sf_dir))
    return cleaned.select("review_id", "translated_review")


@_register
def positive_reviews(spark, sf_dir):
    cleaned = plans.clean_reviews(reviews_raw(spark, sf_dir))
    positive = ops.with_label(cleaned, "sentiment", "positive")
    return positive.select("review_id", "sentiment_normalized", "translated_review")


@_register
def domain_violations(spark, sf_dir):
    return ops.domain_violations(apps_raw(spark, sf_dir), plans.APP_DOMAINS)


@_register
def domain_nulled(spark, sf_dir):
    nulled = ops.null_out_of_domain(apps_raw(spark, sf_dir), plans.APP_DOMAINS)
    return fn.nan_to_null(nulled, "rating").select("app_id", "type", "rating")


@_register
def reviews_valid_sentiment(spark, sf_dir):
    complete = plans.complete_reviews(reviews_raw(spark, sf_dir))
    return ops.valid_scores(complete, plans.SCORES)


# --- aggregations and profiling -----------------------------------------------


@_register
def app_missing_before(spark, sf_dir):
    return ops.missing_counts(apps_raw(spark, sf_dir), plans.APP_MISSING)


@_register
def rating_mean(spark, sf_dir):
    mean = ops.exact_mean(apps_raw(spark, sf_dir), "rating")
    return spark.range(1).select(F.lit(mean).cast("double").alias("rating_mean"))


@_register
def rating_median(spark, sf_dir):
    median = ops.exact_quantile(apps_raw(spark, sf_dir), "rating", 0.5)
    return spark.range(1).select(F.lit(median).cast("double").alias("rating_median"))


@_register
def rating_median_approx(spark, sf_dir):
    """Whether the rank of the approximate median is within its error."""
    apps = fn.nan_to_null(apps_raw(spark, sf_dir), "rating").where("rating IS NOT NULL")
    found = ops.approximate_quantile(apps, "rating", 0.5, 0.01)
    below, upto = F.count_if(F.col("rating") < found), F.count_if(F.col("rating") <= found)
    rows = F.count("*")
    within = (below <= rows * 0.51) & (upto >= rows * 0.49)
    return apps.agg(rows.alias("n_rows"), within.alias("within_error"))


@_register
def numeric_medians(spark, sf_dir):
    """Medians of four columns from the same two passes."""
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    return ops.quantile_table(lines, inputs.NUMERIC)


@_register
def fill_values(spark, sf_dir):
    model = plans.fit_apps(apps_raw(spark, sf_dir), keep=True)
    return model.as_frame(spark)


@_register
def column_modes(spark, sf_dir):
    return ops.column_modes(apps_raw(spark, sf_dir), MODE_RULES)


@_register
def numeric_modes(spark, sf_dir):
    modes = ops.column_modes(numbers(spark, sf_dir), {"size": fn.NULL, "balance": fn.NULL})
    return modes.withColumn("mode", F.col("mode").cast("double"))


@_register
def bounded_modes(spark, sf_dir):
    """Modes of all columns, the unique names included, without shuffling their values."""
    apps = apps_raw(spark, sf_dir).drop("rating")
    return ops.bounded_modes_table(apps, {c: fn.AUDIT for c in apps.columns})


@_register
def missing_wide(spark, sf_dir):
    return ops.missing_wide(apps_raw(spark, sf_dir))


@_register
def missing_wide_reviews(spark, sf_dir):
    return ops.missing_wide(reviews_raw(spark, sf_dir))


@_register
def missing_long(spark, sf_dir):
    return ops.missing_long(plans.complete_reviews(reviews_raw(spark, sf_dir)))


@_register
def observed_audit(spark, sf_dir):
    """The audit of ``missing_pct``, counted while the reviews are written."""
    complete = plans.complete_reviews(reviews_raw(spark, sf_dir))
    return ops.snapshot_with_audit(complete, shared_folder(spark, "observed_audit"))[1]


@_register
def missing_pct(spark, sf_dir):
    return ops.missing_percentages(plans.complete_reviews(reviews_raw(spark, sf_dir)))


@_register
def review_length_hist(spark, sf_dir):
    complete = plans.complete_reviews(reviews_raw(spark, sf_dir))
    return ops.length_histogram(complete, "translated_review", 1, 10)


@_register
def review_length_dist(spark, sf_dir):
    complete = plans.complete_reviews(reviews_raw(spark, sf_dir))
    return ops.length_distribution(complete, "translated_review")


@_register
def type_distribution(spark, sf_dir):
    apps = apps_raw(spark, sf_dir)
    model = ops.fit_modes(apps, {"type": fn.BLANK})
    return ops.value_distribution(model.transform(apps), "type")


@_register
def impute_report(spark, sf_dir):
    apps = apps_raw(spark, sf_dir)
    return ops.impute_report(apps, plans.fit_apps(apps))


@_register
def word_counts(spark, sf_dir):
    return ops.word_counts(
        plans.positive_texts(reviews_raw(spark, sf_dir)), "translated_review"
    )


@_register
def row_missing_profile(spark, sf_dir):
    return ops.row_missing_profile(reviews_raw(spark, sf_dir), plans.CRITICAL)


# --- missing-value handling ---------------------------------------------------


@_register
def nan_to_null(spark, sf_dir):
    columns = ("rating", "content_rating", "current_ver", "android_ver")
    return fn.nan_to_null(apps_raw(spark, sf_dir), *columns).select("app_id", *columns)


@_register
def rating_imputed(spark, sf_dir):
    apps = apps_raw(spark, sf_dir)
    return ops.fit_median(apps, "rating").transform(apps).select("app_id", "rating")


@_register
def rating_mean_imputed(spark, sf_dir):
    imputed = plans.impute_mean_rating(apps_raw(spark, sf_dir))
    return imputed.select("app_id", F.round("rating", 6).alias("rating"))


@_register
def type_imputed(spark, sf_dir):
    apps = apps_raw(spark, sf_dir)
    model = ops.fit_modes(apps, {"type": fn.BLANK})
    return model.transform(apps).select("app_id", "type")


@_register
def content_rating_imputed(spark, sf_dir):
    apps = apps_raw(spark, sf_dir)
    model = ops.fit_modes(apps, {"content_rating": fn.NAN})
    return model.transform(apps).select("app_id", "content_rating")


@_register
def versions_imputed(spark, sf_dir):
    apps = apps_raw(spark, sf_dir)
    model = ops.fit_modes(apps, {"current_ver": fn.NAN, "android_ver": fn.NAN})
    return model.transform(apps).select("app_id", "current_ver", "android_ver")


@_register
def type_domain_imputed(spark, sf_dir):
    apps = apps_raw(spark, sf_dir)
    rule = fn.Missing(blank=True, allowed=plans.APP_DOMAINS["type"].allowed)
    return ops.fit_modes(apps, {"type": rule}).transform(apps).select("app_id", "type")


@_register
def all_columns_imputed(spark, sf_dir):
    return plans.impute_all(apps_raw(spark, sf_dir), keys=("app_id",))


# --- conversions ------------------------------------------------------------------


@_register
def reviews_to_int(spark, sf_dir):
    value = fn.digits_to_integer(F.col("reviews")).cast("double")
    return apps_raw(spark, sf_dir).select("app_id", value.alias("reviews"))


@_register
def installs_to_int(spark, sf_dir):
    value = fn.digits_to_integer(F.col("installs")).cast("double")
    return apps_raw(spark, sf_dir).select("app_id", value.alias("installs"))


@_register
def price_to_double(spark, sf_dir):
    value = fn.amount_to_double(F.col("price"))
    return apps_raw(spark, sf_dir).select("app_id", value.alias("price"))


@_register
def last_updated_to_date(spark, sf_dir):
    value = fn.long_date(F.col("last_updated")).cast("string")
    return apps_raw(spark, sf_dir).select(
        "app_id", "last_updated", value.alias("last_updated_date")
    )


@_register
def sentiment_to_float(spark, sf_dir):
    scores = plans.scored(reviews_raw(spark, sf_dir))
    return _plain_scores(scores.select("review_id", *plans.SCORES))


@_register
def reviews_clean(spark, sf_dir):
    cleaned = plans.with_clean_text(plans.complete_reviews(reviews_raw(spark, sf_dir)))
    return cleaned.select("review_id", "translated_review")


# --- whole flows ---------------------------------------------------------------


def _shown_apps(df: DataFrame) -> DataFrame:
    """Counts with gaps as double and dates as text, for comparison."""
    return df.withColumns(
        {
            "reviews": F.col("reviews").cast("double"),
            "installs": F.col("installs").cast("double"),
            "last_updated_date": F.col("last_updated_date").cast("string"),
        }
    )


@_register
def app_clean(spark, sf_dir):
    return _shown_apps(plans.clean_apps(apps_raw(spark, sf_dir)))


@_register
def app_clean_lazy(spark, sf_dir):
    """As ``app_clean``, with the fits in the plan."""
    apps = apps_raw(spark, sf_dir)
    return _shown_apps(plans.clean_apps(apps, plans.fit_apps(apps, lazy=True)))


@_register
def incremental_fill_values(spark, sf_dir):
    """Fill values from the stored states of three batches, of which one came twice."""
    apps, path = apps_raw(spark, sf_dir), shared_folder(spark, "fill_states")
    for batch in (0, 1, 2, 1):
        part = apps.where(F.col("app_id") % 3 == batch)
        state.write_batch(state.column_state(part, MODE_RULES, ["rating"]), path, f"b{batch}")
    model = state.fit_from_state(state.read_batches(spark, path), MODE_RULES, ["rating"])
    return model.as_frame(spark)


@_register
def reviews_clean_full(spark, sf_dir):
    cleaned = plans.clean_reviews(reviews_raw(spark, sf_dir))
    return _long(_plain_scores(cleaned), "review_length")


@_register
def top_positive_words(spark, sf_dir):
    return flagship(spark, sf_dir)
