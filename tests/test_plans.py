"""Whole flows: known results, types, post-conditions and physical plans."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from scrubline import operators as ops
from scrubline import plans, sources
from scrubline.checks import QUERIES
from scrubline.checks.inputs import apps_raw, reviews_raw
from scrubline.functions import AUDIT, BLANK, NAN, nan_to_null
from scrubline.plans import whole

SF = {"0.001": "/root/testdata/sf0.001", "0.01": "/root/testdata/sf0.01"}

# Results of both engines on the two smaller scale factors (FIXTURES.md).
KNOWN = {
    "0.001": {
        "rating_median": 2.9,
        "rating_mean": 3.126347,
        "app_missing_before": (200, 33, 25, 28, 23, 10),
        "modes": ("Free", "Everyone", "1.1", "4.0 and up"),
        "type_distribution": {"Free": 156, "Paid": 34, "0": 6, "NaN": 4},
        "domain_violations": {"type": 10, "rating": 2},
        "reviews": (195, 674611),
        "installs": 134,
        "price": (193, 36395.97),
        "dates": 125,
        "complete": 296,
        "row_missing_profile": {0: 296, 1: 98, 2: 4, 3: 1, 4: 1},
        "non_numeric_counts": {"sentiment_polarity": 15, "sentiment_subjectivity": 12},
        "valid": 215,
        "hist": {1: 13, 2: 26, 3: 26, 4: 8, 5: 21, 6: 10, 7: 8, 8: 9, 9: 10, 10: 1},
        "long_enough": 257,
        "positive": 94,
        "words": (24071, 7896),
        "top": [("the", 777), ("ci", 647), ("of", 470), ("de", 409), ("and", 340)],
    },
    "0.01": {
        "rating_median": 3.0,
        "rating_mean": 3.167223,
        "app_missing_before": (2000, 322, 251, 267, 223, 96),
        "modes": ("Free", "Everyone", "1.1", "4.0 and up"),
        "type_distribution": {"Free": 1576, "Paid": 327, "0": 57, "NaN": 40},
        "domain_violations": {"type": 97, "rating": 18},
        "reviews": (1949, 67731226),
        "installs": 1334,
        "price": (1939, 379959.7),
        "dates": 1250,
        "complete": 1501,
        "row_missing_profile": {0: 1501, 1: 445, 2: 52, 3: 1, 4: 1},
        "non_numeric_counts": {"sentiment_polarity": 61, "sentiment_subjectivity": 44},
        "valid": 1147,
        "hist": {1: 64, 2: 126, 3: 113, 4: 54, 5: 113, 6: 49, 7: 54, 8: 49, 9: 51},
        "long_enough": 1311,
        "positive": 511,
        "words": (133845, 28540),
        "top": [("the", 5323), ("of", 3042), ("and", 2241), ("ci", 1852), ("de", 1698)],
    },
}


@pytest.mark.parametrize("sf", sorted(SF))
def test_known_results(spark, sf):
    want = KNOWN[sf]

    def run(name):
        return QUERIES[name](spark, SF[sf])

    def pairs(name):
        return {r[0]: r[1] for r in run(name).collect()}

    assert run("rating_median").first()[0] == want["rating_median"]
    assert round(run("rating_mean").first()[0], 6) == want["rating_mean"]
    assert tuple(run("app_missing_before").first()) == want["app_missing_before"]
    assert tuple(pairs("column_modes").values()) == want["modes"]
    assert pairs("type_distribution") == want["type_distribution"]
    assert pairs("domain_violations") == want["domain_violations"]
    assert tuple(run("reviews_to_int").agg(F.count("reviews"), F.sum("reviews")).first()) == want["reviews"]
    assert run("installs_to_int").agg(F.count("installs")).first()[0] == want["installs"]
    price = run("price_to_double").agg(F.count("price"), F.round(F.sum("price"), 2)).first()
    assert tuple(price) == want["price"]
    assert run("last_updated_to_date").agg(F.count("last_updated_date")).first()[0] == want["dates"]
    assert run("reviews_complete").count() == want["complete"]
    assert pairs("row_missing_profile") == want["row_missing_profile"]
    assert pairs("non_numeric_counts") == want["non_numeric_counts"]
    assert run("reviews_valid_sentiment").count() == want["valid"]
    assert pairs("review_length_hist") == want["hist"]
    assert run("reviews_min_length").count() == want["long_enough"]
    assert run("positive_reviews").count() == want["positive"]
    assert tuple(run("word_counts").agg(F.sum("n"), F.count("*")).first()) == want["words"]
    top = [tuple(r) for r in run("top_positive_words").collect()]
    assert len(top) == 20 and top[:5] == want["top"]


@pytest.mark.parametrize("scale", ["0.001", "0.01", "0.1"])
def test_every_character_of_the_documents_reaches_the_reviews(spark, scale):
    sf_dir = f"/root/testdata/sf{scale}"
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    given = documents.select(F.col("doc_id").alias("review_id"), F.col("text").alias("translated_review"))
    whole_texts = reviews_raw(spark, sf_dir).select("review_id", "translated_review")
    assert given.exceptAll(whole_texts).isEmpty()


# --- post-conditions -----------------------------------------------------------


def test_clean_apps_has_no_gaps_and_keeps_values(spark, ansi):
    apps = apps_raw(spark, SF["0.001"])
    clean = plans.clean_apps(apps)
    assert clean.columns == ["app_id", *plans.apps.CLEAN_ORDER]
    types = dict(clean.dtypes)
    assert (types["rating"], types["reviews"], types["installs"]) == ("double", "int", "int")
    assert (types["price"], types["last_updated_date"]) == ("double", "date")
    assert clean.count() == apps.count()
    left = ops.missing_counts(clean, plans.APP_MISSING).first().asDict()
    assert left.pop("rows") == 200 and set(left.values()) == {0}
    both = nan_to_null(apps, "rating").alias("a").join(clean.alias("c"), "app_id")
    changed = both.where(
        "a.rating IS NOT NULL AND a.rating <> c.rating OR trim(a.type) <> '' AND a.type <> c.type"
    )
    assert changed.count() == 0


def test_clean_apps_from_text_columns(spark, ansi):
    apps = apps_raw(spark, SF["0.001"])
    text = apps.withColumn("rating", F.col("rating").cast("string"))
    assert sorted(plans.clean_apps(text).collect()) == sorted(plans.clean_apps(apps).collect())


def test_clean_apps_with_a_given_model(spark):
    apps = apps_raw(spark, SF["0.001"])
    model = plans.fit_apps(apps, relative_error=0.01)
    assert abs(model.value("rating") - 2.9) <= 0.2
    wide = plans.clean_apps(apps, model, count_type="bigint")
    assert dict(wide.dtypes)["installs"] == "bigint"
    assert wide.where("installs > 2147483647").count() > 0


def test_impute_all_leaves_nothing_missing(spark, ansi):
    full = plans.impute_all(apps_raw(spark, SF["0.001"]), keys=("app_id",))
    assert set(ops.missing_wide(full, rule=AUDIT).first()) - {0} <= {
        # Text that reads as NaN stays in ``type``, where only blanks are missing.
        ops.missing_wide(full, ["type"]).first()[0]
    }
    assert ops.missing_counts(full, {"type": BLANK}).first()["type_missing"] == 0


def test_clean_reviews_of_an_empty_table(spark, ansi):
    reviews = reviews_raw(spark, SF["0.001"]).limit(0)
    assert plans.clean_reviews(reviews).count() == 0
    assert plans.top_positive_words(reviews).collect() == []


def test_clean_apps_of_an_empty_table(spark, ansi):
    assert plans.clean_apps(apps_raw(spark, SF["0.001"]).limit(0)).count() == 0


def test_clean_reviews_types_and_order_of_steps(spark, ansi):
    reviews = reviews_raw(spark, SF["0.001"])
    clean = plans.clean_reviews(reviews)
    types = dict(clean.dtypes)
    assert types["sentiment_polarity"] == types["sentiment_subjectivity"] == "float"
    assert types["review_length"] == "int"
    assert clean.agg(F.min("review_length")).first()[0] >= 3
    # Text 'nan' is a text like any other here; scores 'nan' become NaN.
    assert clean.where("translated_review = 'nan'").count() > 0
    assert clean.where(F.isnan("sentiment_polarity")).count() > 0


def test_words_of_cleaned_and_raw_texts_agree(spark):
    reviews = reviews_raw(spark, SF["0.01"])
    positive = ops.with_label(plans.clean_reviews(reviews), "sentiment", "positive")
    cleaned = ops.word_counts(positive, "translated_review")
    raw = ops.word_counts(plans.positive_texts(reviews), "translated_review")
    assert sorted(cleaned.collect()) == sorted(raw.collect())


def test_review_rating_is_imputed_only_if_present(spark, ansi):
    reviews = reviews_raw(spark, SF["0.001"])
    assert plans.impute_mean_rating(reviews) is reviews
    rated = reviews.withColumn("rating", F.when(F.col("review_id") % 2 == 0, 4.0))
    clean = plans.clean_reviews(rated)
    assert clean.select("rating").distinct().collect() == [(4.0,)]


def test_rating_audit_before_and_after(spark):
    apps = apps_raw(spark, SF["0.001"])
    model = plans.fit_apps(apps)
    report = {r.column: (r.before, r.after) for r in ops.impute_report(apps, model).collect()}
    assert report["rating"] == (33, 0) and report["type"] == (25, 0)
    assert ops.missing_report(apps, "rating", NAN).first().pct == 16.5


def test_prepare_from_csv_files(spark, tmp_path, monkeypatch):
    """CSV files in, cleaned snapshots, loaded tables and reports out."""
    apps = apps_raw(spark, SF["0.001"])
    reviews = reviews_raw(spark, SF["0.001"])
    app_csv, review_csv = str(tmp_path / "apps"), str(tmp_path / "reviews")
    sources.write_csv(apps.drop("app_id").toDF(*sources.APP_HEADERS), app_csv)
    sources.write_csv(reviews.drop("review_id").toDF(*sources.REVIEW_HEADERS), review_csv)
    loaded = {}
    monkeypatch.setattr(
        whole, "load_tables", lambda t, *_: loaded.update({n: df.count() for n, df in t.items()})
    )
    out = plans.prepare(
        spark, app_csv, [review_csv], str(tmp_path / "out"), sources.JdbcTarget("jdbc:x")
    )
    # The files hold empty text as a gap, which a review must not have.
    stored = reviews.replace("", None, ["sentiment_subjectivity"]).drop("review_id")
    assert sorted(map(repr, out["apps"].collect())) == sorted(
        map(repr, plans.clean_apps(apps.drop("app_id").replace("", None, ["reviews"])).collect())
    )
    assert sorted(map(repr, out["reviews"].collect())) == sorted(
        map(repr, plans.clean_reviews(stored).collect())
    )
    assert loaded == {"apps": 200, "reviews": out["reviews"].count()}
    assert out["positive_words"].collect() == plans.top_positive_words(stored).collect()
    values = {r.column: r.value for r in out["app_fill_values"].collect()}
    assert values["rating"] == "2.9" and values["type"] == "Free"
    for name, frame in out.items():
        assert (frame.count() > 0) != name.startswith("malformed"), name
    assert {p.name for p in (tmp_path / "out" / "reports").iterdir()} == {
        "app_fill_values", "app_types", "review_lengths", "positive_words", "counts"
    }
    raw = {n: spark.read.parquet(str(tmp_path / "out" / "raw" / n)) for n in ("apps", "reviews")}
    typed, complete = whole.typed_rating(raw["apps"]), plans.complete_reviews(raw["reviews"])
    model = plans.fit_apps(typed)
    same = {
        "app_shape": ops.table_shape(typed),
        "review_shape": ops.table_shape(raw["reviews"]),
        "app_imputation": ops.impute_report(typed, model),
        "app_domain_violations": ops.domain_violations(typed, plans.APP_DOMAINS),
        "app_missing": ops.missing_long(model.transform(typed)),
        "review_missing": ops.missing_percentages(raw["reviews"]),
        "complete_review_missing": ops.missing_percentages(complete),
        "review_non_numeric": ops.non_numeric_counts(complete, plans.SCORES),
    }
    for name, report in same.items():
        assert out[name].columns == report.columns
        assert sorted(map(tuple, out[name].collect())) == sorted(map(tuple, report.collect())), name


def test_fits_on_kept_columns_are_the_same(spark):
    apps = apps_raw(spark, SF["0.001"])
    assert plans.fit_apps(apps, keep=True) == plans.fit_apps(apps)
    assert not spark.sparkContext._jsc.getPersistentRDDs()


@pytest.mark.parametrize("name", ["type_distribution", "review_length_dist"])
def test_reports_come_in_their_order(spark, name):
    rows = [tuple(r) for r in QUERIES[name](spark, SF["0.01"]).collect()]
    by_count = name == "type_distribution"
    assert rows == sorted(rows, key=lambda r: (-r[1], r[0]) if by_count else r[0])


def test_top_words_come_in_their_order(spark):
    rows = [tuple(r) for r in QUERIES["top_positive_words"](spark, SF["0.01"]).collect()]
    counts = [tuple(r) for r in QUERIES["word_counts"](spark, SF["0.01"]).collect()]
    assert rows == sorted(counts, key=lambda r: (-r[1], r[0]))[:20]


def largest_method(df) -> int:
    """Bytes of the largest generated method of a frame's stages."""
    stages = df._jdf.queryExecution().debug().codegenToSeq()
    return max((stages.apply(i)._3().maxMethodCodeSize() for i in range(stages.size())), default=0)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_generated_methods_stay_compilable(spark, name):
    # The JVM interprets methods from 8,000 bytes on.
    assert largest_method(QUERIES[name](spark, SF["0.001"])) < 8000


# --- physical plans ---------------------------------------------------------------


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


WRITING = {"csv_malformed_rows", "csv_roundtrip", "csv_split_roundtrip", "parquet_roundtrip"}
# The ledger compares two tables of files; a lazy median adds up the counts of its bracket.
ALLOWED = {"load_manifest": {"Join"}, "app_clean_lazy": {"Window"}}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - WRITING))
def test_no_python_and_no_joins(spark, name):
    plan = physical(QUERIES[name](spark, SF["0.001"]))
    found = set(re.findall("Python|Pandas|Cartesian|NestedLoop|Join|ExistingRDD|Window", plan))
    assert found <= ALLOWED.get(name, set())


NARROW = [
    "app_clean", "reviews_clean_full", "reviews_complete", "reviews_valid_sentiment",
    "all_columns_imputed", "jdbc_ready_apps", "positive_reviews", "nan_to_null",
]


@pytest.mark.parametrize("name", NARROW)
def test_row_wise_results_do_not_shuffle(spark, name):
    assert "Exchange" not in physical(QUERIES[name](spark, SF["0.001"]))


@pytest.mark.parametrize("name", ["missing_wide", "missing_pct", "impute_report", "app_missing_before"])
def test_audits_are_one_pass(spark, name):
    plan = physical(QUERIES[name](spark, SF["0.001"]))
    # The review input is a union of two scans; each is read once.
    scans = 2 if name == "missing_pct" else 1
    assert plan.count("FileScan") == scans and plan.count("Exchange") == 1


def test_top_words_shuffles_counts_once_and_reads_two_columns(spark):
    plan = physical(QUERIES["top_positive_words"](spark, SF["0.001"]))
    assert plan.count("Exchange") == 1 and "TakeOrderedAndProject" in plan
    assert "partial_count" in plan
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in plan


def test_cleaning_runs_once_per_row(spark):
    plan = physical(QUERIES["reviews_clean_full"](spark, SF["0.001"]))
    branches = plan.count("FileScan")
    assert branches == 2 and plan.count("regexp_replace(") == branches


def test_modes_count_before_the_shuffle_and_never_sort(spark):
    plan = physical(QUERIES["column_modes"](spark, SF["0.001"]))
    assert plan.count("Exchange hashpartitioning") == 1
    assert not re.search(r"\bSort \[", plan)
    assert plan.index("partial_min") < plan.index("partial_count")


def test_preview_cleans_only_what_it_shows(spark):
    plan = physical(QUERIES["preview_reviews"](spark, SF["0.001"]))
    assert "TakeOrderedAndProject" in plan and "<=" in plan


def test_cleaning_of_a_snapshot_has_a_margin(spark, tmp_path):
    apps = sources.write_snapshot(apps_raw(spark, SF["0.001"]), str(tmp_path / "apps"))
    reviews = sources.write_snapshot(reviews_raw(spark, SF["0.001"]), str(tmp_path / "reviews"))
    for clean in (plans.clean_apps(apps), plans.clean_reviews(reviews)):
        assert largest_method(clean) < 7000
