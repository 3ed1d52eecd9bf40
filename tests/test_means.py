"""Sums and means that do not depend on the order, against exact fractions."""

from __future__ import annotations

import math
import random
from fractions import Fraction
from functools import reduce
from operator import add

import pytest

from scrubline import functions as fn
from scrubline.operators.impute import fit_mean
from scrubline.operators.means import exact_mean, exact_sums


def exact(values):
    held = [v for v in values if v is not None and not math.isnan(v)]
    return sum(map(Fraction, held)), len(held)


def columns(seed, rows=3000):
    random.seed(seed)
    edge = [5e-324, -5e-324, 2.2250738585072014e-308, 1.7976931348623157e308, -1.7976931348623157e308, 2.0**52, 2.0**-1022, 0.0, -0.0]
    return {
        "tenth": [random.randrange(51) / 10 for _ in range(rows)],
        "wide": [math.ldexp(random.uniform(-1, 1), random.randrange(-1074, 1000)) for _ in range(rows)],
        "near": [math.nextafter(2.0**i, d) for i in range(-1000, 1000) for d in (0, math.inf)][:rows],
        "edge": [random.choice(edge) for _ in range(rows)],
        "cancel": [x for i in range(rows // 2) for x in (1e300 + i, -1e300 - i)],
        "gaps": [random.choice([None, float("nan"), 1 / 3]) for _ in range(rows)],
    }


@pytest.mark.parametrize("partitions", [1, 7, 211])
def test_rounded_once_in_any_order(spark, partitions):
    data = columns(1)
    rows = list(zip(*data.values()))
    random.Random(partitions).shuffle(rows)
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in data)).repartition(partitions)
    found = exact_sums(df, data)
    for name, values in data.items():
        total, n = exact(values)
        assert (found[name].n, Fraction(found[name].whole, 2 ** found[name].shift)) == (n, total), name
        assert found[name].mean() == total.numerator / (total.denominator * n)


def test_infinite_empty_and_text(spark):
    inf = float("inf")
    df = spark.createDataFrame([(inf, inf, None, "1.5", 1e308), (1.0, -inf, None, "x", 1e308)], "a double, b double, c double, d string, e double")
    found = exact_sums(df, df.columns)
    assert found["a"].mean() == inf and math.isnan(found["b"].total()) and found["c"].mean() is None
    assert found["d"].total() == 1.5 and found["e"].total() == inf and found["e"].mean() == 1e308
    assert exact_mean(df.limit(0), "a") is None and exact_sums(df, []) == {}
    assert fit_mean(df, "d").value("d") == 1.5
    assert fit_mean(df, "c").fills[0].missing == fn.NAN


def test_ordinary_sums_do_depend_on_the_order():
    values = columns(1)["tenth"]
    assert len({reduce(add, random.Random(i).sample(values, len(values))) for i in range(20)}) > 1
