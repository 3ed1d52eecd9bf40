"""Exact quantiles of several columns against sorting."""

from __future__ import annotations

import math
import random
from dataclasses import replace

import pytest

from scrubline.operators import quantiles


def plain(values, q):
    held = sorted(v for v in values if v is not None and not math.isnan(v))
    return held[max(1, math.ceil(q * len(held))) - 1] if held else None


def table(spark, rows=4000, seed=1):
    random.seed(seed)
    data = [
        (
            random.random(),
            float(random.randrange(4)),
            random.choice([None, float("nan"), random.expovariate(1)]),
            5.0 if i % 3 else random.random() * 10,
            None,
            random.choice(["7", "x", "nan", " 2.5 ", None]),
            random.choice([float("inf"), -float("inf"), 1.0]),
        )
        for i in range(rows)
    ]
    df = spark.createDataFrame(data, "a double, b double, c double, d double, e double, f string, g double").repartition(6)
    texts = {"7": 7.0, " 2.5 ": 2.5}
    columns = [list(c) for c in zip(*data)]
    columns[5] = [texts.get(v) for v in columns[5]]
    return df, dict(zip(df.columns, columns))


@pytest.mark.parametrize("small", [10, 200, 200_000])
@pytest.mark.parametrize("q", [0.0, 0.01, 0.5, 0.999, 1.0])
def test_against_sorting(spark, q, small):
    df, columns = table(spark)
    assert quantiles.exact_quantiles(df, df.columns, q, small) == {c: plain(v, q) for c, v in columns.items()}


def test_a_wrong_sketch_costs_passes_only(spark, monkeypatch):
    df, columns = table(spark)
    right, calls = quantiles._narrowed, []

    def wrong(at, before, n, points, q):
        calls.append(at)
        found = right(at, before, n, points, q)
        return replace(found, low=points[-1] + 1, high=points[-1] + 2) if len(calls) <= 3 else found

    monkeypatch.setattr(quantiles, "_narrowed", wrong)
    assert quantiles.exact_quantiles(df, ["a", "b"], 0.5) == {c: plain(columns[c], 0.5) for c in "ab"}
    assert len(calls) > 3


def test_two_scans(spark, monkeypatch):
    df, _ = table(spark)
    jobs = []
    for name in ("_sketches", "_counted"):
        run = getattr(quantiles, name)
        monkeypatch.setattr(quantiles, name, lambda *a, run=run, name=name: jobs.append(name) or run(*a))
    quantiles.exact_quantiles(df, df.columns)
    assert jobs == ["_sketches", "_counted"]


def test_one_row_and_none(spark):
    df = spark.createDataFrame([(2.5, None)], "a double, b double")
    assert quantiles.exact_quantiles(df, ["a", "b", "a"]) == {"a": 2.5, "b": None}
    assert quantiles.exact_quantiles(df.limit(0), ["a"]) == {"a": None}
    assert quantiles.exact_quantiles(df, []) == {}
    assert [tuple(r) for r in quantiles.quantile_table(df, ["a", "b"]).collect()] == [("a", 2.5), ("b", None)]
