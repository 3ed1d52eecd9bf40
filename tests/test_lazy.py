"""Fits inside the plan, and fits from the states of batches."""

from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T
from test_observed import jobs
from test_quantiles import plain, table

from scrubline import functions as fn
from scrubline import plans
from scrubline.checks.inputs import apps_raw
from scrubline.operators import impute, lazy, state

SF = "/root/testdata/sf0.001"


def test_a_lazy_model_runs_no_job(spark):
    apps = apps_raw(spark, SF)
    model, before = jobs(spark, lambda: plans.fit_apps(apps, lazy=True))
    clean, building = jobs(spark, lambda: plans.clean_apps(apps, model))
    assert before == building == 0
    want = plans.clean_apps(apps, plans.fit_apps(apps))
    assert sorted(map(repr, clean.collect())) == sorted(map(repr, want.collect()))
    texts = {r.column: r.value for r in model.as_frame(spark).collect()}
    assert texts == {r.column: r.value for r in plans.fit_apps(apps).as_frame(spark).collect()}


def test_a_view_follows_its_table(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([("a", 1.0), ("a", 2.0), (None, None)], "t string, x double").write.parquet(path)
    df = spark.read.schema("t string, x double").parquet(path)
    model = impute.fit_modes(df, {"t": fn.NULL}, lazy=True) + impute.fit_mean(df, "x", lazy=True)
    model.transform(df).createOrReplaceTempView("filled")
    assert {tuple(r) for r in spark.sql("select * from filled").collect()} == {("a", 1.0), ("a", 2.0), ("a", 1.5)}
    spark.createDataFrame([("b", 6.0)] * 3, "t string, x double").write.mode("append").parquet(path)
    spark.catalog.refreshByPath(path)
    df.createOrReplaceTempView("grown")
    later = spark.read.schema("t string, x double").parquet(path)
    again = impute.fit_modes(later, {"t": fn.NULL}, lazy=True).transform(later)
    assert again.where("t is null").count() == 0 and again.where("t = 'b'").count() == 4


@pytest.mark.parametrize("q", [0.0, 0.3, 0.5, 1.0])
def test_lazy_quantiles(spark, q):
    df, columns = table(spark)
    found = spark.range(1).select(*(lazy.lazy_quantile(df, c, q).alias(c) for c in df.columns)).first()
    assert found.asDict() == {c: plain(v, q) for c, v in columns.items()}


def test_a_wrong_sketch_is_an_error(spark, monkeypatch):
    monkeypatch.setattr(lazy, "ERROR", -0.05)
    with pytest.raises(Exception, match="missed the quantile"):
        spark.range(10_000).select(lazy.lazy_quantile(spark.range(10_000), "id").alias("m")).collect()


RULES = {"t": fn.BLANK, "k": fn.NULL}


def batches(spark, seed):
    random.seed(seed)
    rows = [(random.choice(["a", "b", " ", None]), random.choice([9, 10, None]), random.choice([None, random.gauss(0, 1)])) for _ in range(900)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, t string, k int, x double")
    return df, [df.where(f"i % 3 = {b}") for b in range(3)]


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("small", [5, 50_000])
def test_batches_add_up_to_the_whole(spark, tmp_path, seed, small, monkeypatch):
    monkeypatch.setattr(state, "SMALL", small)
    monkeypatch.setattr(state, "STEPS", 7)
    whole, parts = batches(spark, seed)
    path = str(tmp_path / "states")
    for name, part in enumerate([*parts, parts[1]]):
        state.write_batch(state.column_state(part, RULES, ["x"]), path, f"day-{name % 3 if name < 3 else 1}")
    kept = state.read_batches(spark, path)
    model = state.fit_from_state(kept, RULES, ["x"], {"k": T.IntegerType()})
    assert model == impute.fit_median(whole, "x") + impute.fit_modes(whole, RULES)
    gaps = {r.column: (r.rows, r.missing) for r in state.gap_counts(kept).collect()}
    blank = whole.where("t is null or trim(t) = ''").count()
    assert gaps["t"] == (900, blank) and gaps["x"] == (900, whole.where("x is null").count())


def test_odd_states(spark, tmp_path):
    df = spark.createDataFrame([(None, None, math.inf), (None, None, -math.inf), (None, None, 1e308), (None, None, -1e308)], "t string, k int, x double")
    kept = state.column_state(df.where("abs(x) < 1.5e308"), RULES, ["x"])
    model = state.fit_from_state(kept, RULES, ["x"])
    assert [f.value for f in model.fills] == [-1e308, None, None]
    empty = state.fit_from_state(state.column_state(df.limit(0), RULES, ["x"]), RULES, ["x"])
    assert [f.value for f in empty.fills] == [None, None, None]
    with pytest.raises(ValueError, match="batch name"):
        state.write_batch(kept, str(tmp_path), "../x")
    with pytest.raises(ValueError, match="no columns"):
        state.column_state(df, {})
    assert state.merged(kept.unionAll(kept)).agg(F.sum("n")).first()[0] == 12
