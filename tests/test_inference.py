"""Types that give every text back."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from scrubline import functions as fn
from scrubline.operators.inference import inferred_schema, inferred_types, typed
from scrubline.sources import read_csv

CASES = {
    "flag": (["true", "false", None], "boolean"),
    "yes": (["yes", "no"], "string"),
    "count": (["0", "-7", "2147483647"], "int"),
    "big": (["2147483648", "1"], "bigint"),
    "huge": (["9223372036854775808", "1"], "decimal(19,0)"),
    "version": (["1.10", "1.9", "2.0"], "string"),
    "code": (["007", "12"], "string"),
    "plus": (["+1", "2"], "string"),
    "minus_zero": (["-0", "1"], "string"),
    "money": (["1.10", "0.05", "-12.00"], "decimal(4,2)"),
    "price_or_gap": (["1.10", None, ""], "decimal(3,2)"),
    "share": (["0.5", "0.25", "1.0"], "double"),
    "mixed": (["1", "0.5"], "string"),
    "long": (["0.1234567890123456", "0.5"], "string"),
    "exponent": (["1e5", "2.5"], "string"),
    "nan": (["NaN", "1.5"], "string"),
    "day": (["2020-02-29", "1999-12-31"], "date"),
    "no_day": (["2021-02-29", "1999-12-31"], "string"),
    "time": (["2020-02-29 23:59:59", "1999-12-31 00:00:00"], "timestamp"),
    "padded": ([" 1", "2"], "string"),
    "gaps": ([None, ""], "string"),
    "partly": (["5", "", None], "int"),
    "line": (["1\n", "2"], "string"),
}


@pytest.fixture
def table(spark):
    size = max(len(v) for v, _ in CASES.values())
    columns = [[*v, *[None] * (size - len(v))] for v, _ in CASES.values()]
    return spark.createDataFrame(list(zip(*columns)), ", ".join(f"{c} string" for c in CASES))


def test_lattice(table, ansi):
    assert {c: t for c, (t, _) in inferred_types(table).items()} == {c: t for c, (_, t) in CASES.items()}


def test_every_text_is_given_back(table):
    cast = typed(table)
    back = cast.select(*(F.col(c).cast("string") for c in cast.columns))
    empty_is_gap = table.replace("", None, [c for c, t in cast.dtypes if t != "string"])
    assert sorted(map(repr, back.collect())) == sorted(map(repr, empty_is_gap.collect()))
    assert dict(cast.dtypes)["money"] == "decimal(4,2)" and dict(cast.dtypes)["version"] == "string"


def test_ordinary_inference_loses_versions(spark, tmp_path):
    path = str(tmp_path / "t.csv")
    (tmp_path / "t.csv").write_text("ver,n\n1.10,1\n1.9,2\n")
    assert dict(read_csv(spark, path, infer=True).dtypes)["ver"] == "double"
    assert dict(typed(read_csv(spark, path)).dtypes) == {"ver": "string", "n": "int"}


def test_reasons_rules_and_no_text(spark, table):
    rows = {r.column: (r.type, r.reason) for r in inferred_schema(table.withColumn("id", F.lit(1))).collect()}
    assert rows["id"] == ("int", "given") and rows["gaps"] == ("string", "no values")
    assert rows["code"] == ("string", "1 of 2 are no bigint")
    nan = inferred_types(table.select("nan"), rule=fn.NAN)
    assert nan["nan"][0] == "decimal(2,1)"
    assert inferred_types(spark.range(3)) == {} and typed(spark.range(3)).columns == ["id"]
