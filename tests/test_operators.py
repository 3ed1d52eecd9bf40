from __future__ import annotations

import math
import random
import uuid
from datetime import date

import pytest
from pyspark.sql import functions as F

from scrubline import operators as ops
from scrubline.functions import AUDIT, BLANK, EMPTY, NAN, NULL, Missing
from scrubline.operators.stats import modes_row


def tuples(df):
    return [tuple(r) for r in df.collect()]


@pytest.fixture(scope="module")
def small(spark):
    return spark.createDataFrame(
        [
            (1, "a", 1.0, "x"),
            (2, "a", None, ""),
            (3, "b", float("nan"), None),
            (4, None, 3.0, "  "),
            (5, "b", 4.0, "nan"),
        ],
        "id long, label string, score double, note string",
    )


@pytest.fixture(scope="module")
def empty(small):
    return small.limit(0)


# --- audits ---------------------------------------------------------------------


def test_missing_audits_agree(small, ansi):
    wide = ops.missing_wide(small).first().asDict()
    assert wide == {"id": 0, "label": 1, "score": 2, "note": 3}
    assert dict(tuples(ops.missing_long(small))) == wide
    assert {c: (n, p) for c, n, p in tuples(ops.missing_percentages(small))} == {
        "id": (0, 0.0), "label": (1, 20.0), "score": (2, 40.0), "note": (3, 60.0)
    }


def test_audits_of_an_empty_table(empty, ansi):
    assert tuple(ops.missing_wide(empty).first()) == (0, 0, 0, 0)
    assert {p for _, _, p in tuples(ops.missing_percentages(empty))} == {0.0}
    assert tuples(ops.table_shape(empty)) == [(0, 4)]
    assert tuples(ops.row_missing_profile(empty, {"note": EMPTY})) == []


def test_missing_report_and_counts(small):
    assert tuples(ops.missing_report(small, "note", BLANK)) == [(5, 3, 60.0)]
    counts = ops.missing_counts(small, {"note": BLANK, "score": NAN}).first().asDict()
    assert counts == {"rows": 5, "note_missing": 3, "score_missing": 2}


def test_row_missing_profile(small):
    profile = ops.row_missing_profile(small, {"label": NULL, "score": NAN, "note": EMPTY})
    assert tuples(profile) == [(0, 2), (1, 1), (2, 2)]


def test_non_numeric_counts(spark, ansi):
    df = spark.createDataFrame([("1", "a"), ("x", "nan"), (None, "")], "p string, q string")
    assert tuples(ops.non_numeric_counts(df, ["p", "q"])) == [("p", 1), ("q", 2)]


# --- statistics -------------------------------------------------------------------


def test_modes_and_their_ties(spark, ansi):
    df = spark.createDataFrame(
        [("b", "1", 2.5), ("a", "1", 2.5), ("b", "2", None), ("a", "nan", 1.0), (None, "nan", None),
         ("", "nan", None)],
        "tie string, text string, number double",
    )
    modes = ops.column_modes(df, {"tie": BLANK, "text": NAN, "number": NAN})
    assert tuples(modes) == [("tie", "a", 2), ("text", "1", 2), ("number", "2.5", 2)]


def test_mode_of_a_column_without_values(spark):
    df = spark.createDataFrame([(None, "x"), ("", "x")], "void string, full string")
    assert tuples(ops.column_modes(df, {"void": BLANK, "full": BLANK})) == [
        ("void", None, None), ("full", "x", 2)
    ]


def test_mean_skips_nan(small, empty):
    assert ops.column_mean(small, "score").first()[0] == pytest.approx(8 / 3)
    assert ops.column_mean(empty, "score").first()[0] is None


def test_value_distribution(small):
    assert tuples(ops.value_distribution(small, "label")) == [("a", 2), ("b", 2), (None, 1)]


def expected_quantile(values, q):
    kept = sorted(v for v in values if v is not None and not math.isnan(v))
    return kept[max(1, math.ceil(q * len(kept))) - 1]


RNG = random.Random(1)
SAMPLES = {
    "continuous": [RNG.gauss(0, 1) for _ in range(4000)],
    "few values": [RNG.randrange(41) / 10 for _ in range(4000)],
    "hot value below": [0.0] * 1400 + [float(i) for i in range(2600)],
    "hot value at the median": [float(i) for i in range(1300)] + [1300.0] * 1400
    + [1301.0 + i for i in range(1300)],
    "two hot values": [1.0] * 2000 + [2.0] * 2000,
    "wide range": [(-1.0) ** i * 10.0 ** (i % 300) for i in range(3000)],
    "infinities": [math.inf] * 900 + [-math.inf] * 700 + [float(i) for i in range(1000)],
    "gaps": [None, math.nan] * 500 + [float(i) for i in range(999)],
    "one": [7.0],
}


@pytest.mark.parametrize("name", sorted(SAMPLES))
def test_exact_quantile(spark, name):
    values = SAMPLES[name]
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(4)
    for q in (0.5, 0.1, 1.0):
        want = expected_quantile(values, q)
        # A coarse sketch and a small remainder force several rounds.
        assert ops.exact_quantile(df, "v", q, small=5, steps=20) == want
    assert ops.exact_quantile(df, "v") == expected_quantile(values, 0.5)


def jobs_of(spark, run):
    """(result, number of jobs) of a function that runs Spark jobs."""
    group = f"counted-{uuid.uuid4().hex}"
    spark.sparkContext.setJobGroup(group, group)
    try:
        result = run()
        return result, len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_exact_quantile_of_many_rows_takes_three_scans(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(3_000_000).selectExpr("hash(id) / 7.0D AS v").write.parquet(path)
    df = spark.read.parquet(path)
    found, jobs = jobs_of(spark, lambda: ops.exact_quantile(df, "v"))
    exact = df.selectExpr("percentile_disc(0.5) WITHIN GROUP (ORDER BY v)").first()[0]
    # A sketch (two jobs), a count (two), the rest (one).
    assert found == exact and jobs <= 5


def test_median_and_gap_counts_share_a_pass(spark, small):
    rules = {"label": NULL, "note": BLANK, "id": AUDIT}
    both, jobs = jobs_of(spark, lambda: ops.fit_median_and_modes(small, "score", rules))
    apart, more = jobs_of(
        spark, lambda: ops.fit_median(small, "score") + ops.fit_modes_where_missing(small, rules)
    )
    assert both == apart and jobs < more


def test_approximate_quantile_is_within_its_error(spark):
    values = SAMPLES["continuous"]
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(8)
    found = ops.approximate_quantile(df, "v", 0.5, 0.01)
    rank = sum(v <= found for v in values)
    assert abs(rank - len(values) / 2) <= 0.01 * len(values) + 1
    model = ops.fit_median(df, "v", relative_error=0.01)
    assert model.value("v") == found


def test_quantiles_without_values(empty):
    assert ops.exact_quantile(empty, "score") is None
    assert ops.approximate_quantile(empty, "score") is None


def test_quantile_of_text_numbers(spark, ansi):
    df = spark.createDataFrame([("1",), ("2",), ("x",), ("nan",), ("9",)], "v string")
    assert ops.exact_quantile(df, "v") == 2.0


# --- imputation -------------------------------------------------------------------


def test_imputation_fills_gaps_and_nothing_else(small, ansi):
    model = (
        ops.fit_median(small, "score")
        + ops.fit_modes(small, {"label": NULL, "note": Missing(nan=True, blank=True)})
    )
    filled = model.transform(small)
    assert sorted(tuples(filled)) == [
        (1, "a", 1.0, "x"), (2, "a", 3.0, "x"), (3, "b", 3.0, "x"), (4, "a", 3.0, "x"),
        (5, "b", 4.0, "x"),
    ]
    assert filled.dtypes == small.dtypes
    report = {r[0]: r[1:] for r in tuples(ops.impute_report(small, model))}
    assert report == {
        "score": (2, 0, 40.0), "label": (1, 0, 20.0), "note": (4, 0, 80.0)
    }


def test_mean_imputation(small):
    filled = ops.fit_mean(small, "score").transform(small)
    assert {round(r.score, 6) for r in filled.collect()} == {1.0, 3.0, 4.0, 2.666667}


def test_a_column_has_one_fill(small):
    with pytest.raises(ValueError, match="score"):
        ops.fit_median(small, "score") + ops.fit_mean(small, "score")


def test_empty_lists_of_columns(small):
    assert ops.complete_rows(small, {}).count() == small.count()
    assert ops.incomplete_rows(small, {}).count() == 0
    with pytest.raises(ValueError, match="no columns"):
        ops.missing_wide(small, [])


def test_column_without_values_stays_missing(spark):
    df = spark.createDataFrame([(1, "", float("nan")), (2, None, None)], "id long, s string, d double")
    model = ops.fit_median(df, "d") + ops.fit_modes(df, {"s": BLANK})
    assert [f.value for f in model.fills] == [None, None]
    assert tuples(model.transform(df).orderBy("id")) == [(1, None, None), (2, None, None)]
    assert {r[0]: r[1:3] for r in tuples(ops.impute_report(df, model))} == {
        "d": (2, 2), "s": (2, 2)
    }


def test_typed_modes_come_back_typed(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (None,)], "n int")
    filled = ops.fit_modes(df, {"n": NULL}).transform(df)
    assert filled.dtypes == [("n", "int")]
    assert sorted(r.n for r in filled.collect()) == [1, 1, 1, 2]


def test_numeric_ties_go_to_the_smallest_number(spark, ansi):
    df = spark.createDataFrame(
        [(10, 2.5, date(2020, 1, 1)), (9, 10.0, date(2019, 1, 1)), (None, None, None)],
        "n long, d double, t date",
    )
    model = ops.fit_modes(df, {"n": NULL, "d": NAN, "t": NULL})
    assert [f.value for f in model.fills] == [9, 2.5, date(2019, 1, 1)]
    assert model.transform(df).dtypes == df.dtypes
    assert tuples(ops.column_modes(df, {"n": NULL, "t": NULL})) == [
        ("n", "9", 1), ("t", "2019-01-01", 1)
    ]


def test_modes_only_where_missing(small):
    model = ops.fit_modes_where_missing(small, {"id": AUDIT, "label": NULL, "note": BLANK})
    assert [f.column for f in model.fills] == ["label", "note"]
    full = small.where("id = 1")
    assert ops.fit_modes_where_missing(full, {"id": AUDIT, "label": AUDIT}).fills == ()
    assert tuples(ops.ImputeModel().transform(full)) == tuples(full)


def test_model_as_frame(spark, small):
    model = ops.fit_median(small, "score") + ops.fit_modes(small, {"label": NULL})
    assert tuples(model.as_frame(spark)) == [
        ("score", "median", "3.0"), ("label", "mode", "a")
    ]


# --- quality ---------------------------------------------------------------------


def test_complete_and_incomplete_partition_the_table(small):
    rules = {"label": NULL, "score": NAN, "note": EMPTY}
    kept, rest = ops.complete_rows(small, rules), ops.incomplete_rows(small, rules)
    assert sorted(tuples(kept.select("id")) + tuples(rest.select("id"))) == [
        (i,) for i in range(1, 6)
    ]
    assert tuples(kept.select("id").orderBy("id")) == [(1,), (5,)]


def test_domains(small, ansi):
    domains = {
        "label": ops.Domain(allowed=("a",)),
        "score": ops.Domain(low=0.0, high=3.5),
    }
    assert tuples(ops.domain_violations(small, domains)) == [("label", 2), ("score", 1)]
    nulled = ops.null_out_of_domain(small, domains).orderBy("id").collect()
    assert [r.label for r in nulled] == ["a", "a", None, None, None]
    assert nulled[4].score is None and nulled[0].score == 1.0


def test_range_of_a_text_column(spark, ansi):
    """Text that reads as no number violates a range; gaps do not."""
    df = spark.createDataFrame(
        [(1, "2.5"), (2, "abc"), (3, "9"), (4, None), (5, "nan"), (6, "")], "id int, score string"
    )
    domains = {"score": ops.Domain(low=0.0, high=5.0)}
    assert tuples(ops.domain_violations(df, domains)) == [("score", 3)]
    nulled = ops.null_out_of_domain(df, domains).orderBy("id").collect()
    assert [r.score for r in nulled] == ["2.5", None, None, None, "nan", None]


def test_valid_scores(spark, ansi):
    df = spark.createDataFrame(
        [(1, "0.5", "1"), (2, "nan", "1"), (3, "1", "abc"), (4, None, "1"), (5, "inf", "1"),
         (6, "1", "-Infinity")],
        "id long, p string, q string",
    )
    assert tuples(ops.valid_scores(df, ["p", "q"]).select("id")) == [(1,)]


# --- words and previews --------------------------------------------------------


def test_lengths_labels_and_words(spark):
    df = spark.createDataFrame(
        [(" Positive ", "Good, good app!"), ("positive", "bad"), ("Neutral", "ok"), (None, None)],
        "label string, text string",
    )
    positive = ops.with_label(df, "label", "positive")
    assert sorted(tuples(ops.word_counts(positive, "text"))) == [
        ("app", 1), ("bad", 1), ("good", 2)
    ]
    assert tuples(ops.top_words(positive, "text", 2)) == [("good", 2), ("app", 1)]
    present = df.where("text is not null")
    assert tuples(ops.length_distribution(present, "text")) == [(2, 1), (3, 1), (14, 1)]
    assert tuples(ops.length_histogram(df, "text", 1, 10)) == [(2, 1), (3, 1)]


def test_words_of_nothing(spark):
    df = spark.createDataFrame([("",), ("!!",), (None,)], "text string")
    assert tuples(ops.word_counts(df, "text")) == []


def test_preview(spark):
    df = spark.createDataFrame(
        [(i if i else None, "x" * 30) for i in range(8)], "id long, text string"
    ).repartition(3)
    shown = tuples(ops.preview(df, "id", 3))
    assert shown == [(1, "x" * 17 + "..."), (2, "x" * 17 + "..."), (3, "x" * 17 + "...")]
    assert tuples(ops.preview(df, "id", 2, width=None))[0] == (1, "x" * 30)
    assert [r[0] for r in tuples(ops.preview(df, "id", 20))] == [1, 2, 3, 4, 5, 6, 7, None]
    assert tuples(ops.preview(df.limit(0), "id")) == []


def test_preview_of_tied_keys_does_not_depend_on_the_partitioning(spark):
    df = spark.range(4000).selectExpr("id % 2 AS key", "(id * 7919) % 4000 AS v", "map(1, id) AS m")
    for parts in (1, 3, 16):
        shown = ops.preview(df.repartition(parts), "key", 4).collect()
        assert [(r.key, r.v) for r in shown] == [(0, 0), (0, 2), (0, 4), (0, 6)]


@pytest.mark.parametrize("width,text", [(1, "."), (2, ".."), (3, "..."), (4, "x...")])
def test_preview_is_never_wider_than_asked(spark, width, text):
    df = spark.createDataFrame([(1, "x" * 9)], "id long, text string")
    assert tuples(ops.preview(df, "id", 1, width)) == [(1, text)]


def test_modes_compare_typed_values(spark):
    """Zeros of either sign are one value, instants of a repeated hour are two."""
    zeros = spark.createDataFrame([(v,) for v in (0.0, 0.0, -0.0, -0.0, 5.0, 5.0, 5.0)], "d double")
    zeros = zeros.selectExpr("d", "d > 1 AS flag", "array(d) AS list")
    modes = modes_row(zeros, {"d": NAN, "flag": NULL, "list": NULL}).first()
    assert tuple(modes.d) == (0.0, 4) and tuple(modes.flag) == (False, 4)
    assert tuple(modes.list) == ([0.0], 4)
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        # 01:30 twice on 5 November 2023, then a later instant twice.
        seconds = [1699162200, 1699165800, 1699200000, 1699200000]
        df = spark.createDataFrame([(s,) for s in seconds], "s long").selectExpr("timestamp_seconds(s) AS t")
        row = modes_row(df, {"t": NULL}).selectExpr("unix_seconds(t.value)", "t.n").first()
        assert tuple(row) == (1699200000, 2)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_skewed_words_and_modes(spark):
    """A third of all rows hold one value; results stay whole."""
    df = spark.range(30_000, numPartitions=16).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("w"), F.col("id"))).alias("t")
    )
    counts = ops.word_counts(df, "t")
    assert counts.count() == 20_001
    assert tuples(ops.top_words(df, "t", 1)) == [("hot", 10_000)]
    assert tuples(ops.column_modes(df, {"t": BLANK})) == [("t", "hot", 10_000)]
