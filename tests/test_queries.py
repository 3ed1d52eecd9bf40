"""Every registered query against DuckDB, over whole tables."""

from __future__ import annotations

import pytest
from compare import connect, duck_rows, spark_rows

from scrubline.checks import ORACLE, QUERIES

SCALES = ["/root/testdata/sf0.001", "/root/testdata/sf0.01"]


@pytest.fixture(scope="module", params=SCALES, ids=["sf0.001", "sf0.01"])
def scale(request):
    return request.param, connect(request.param)


def test_every_query_has_its_sql():
    assert set(ORACLE) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_rows(spark, scale, name):
    sf_dir, con = scale
    columns, rows = spark_rows(QUERIES[name](spark, sf_dir))
    expected_columns, expected = duck_rows(con, ORACLE[name])
    assert columns == expected_columns
    assert len(rows) == len(expected) > 0
    assert rows == expected


@pytest.mark.parametrize("name", ["app_clean", "all_columns_imputed", "reviews_clean_full"])
def test_same_rows_without_ansi(spark, name):
    sf_dir = SCALES[0]
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        found = spark_rows(QUERIES[name](spark, sf_dir))
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")
    assert found == duck_rows(connect(sf_dir), ORACLE[name])
