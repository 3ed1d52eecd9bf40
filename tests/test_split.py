"""Split reading of CSV, and published versions of a snapshot."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from scrubline.sources import (
    publish_snapshot,
    read_csv,
    read_csv_split,
    read_published,
    text_schema,
    write_csv,
)
from scrubline.sources.split import records

SCHEMA = text_schema(["a", "b", "c"])


@pytest.fixture
def small_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200b")
    spark.conf.set("spark.sql.files.openCostInBytes", "1b")
    yield
    for key in ("maxPartitionBytes", "openCostInBytes"):
        spark.conf.unset(f"spark.sql.files.{key}")


def rows(df):
    return sorted(map(repr, df.collect()))


def fields(seed, n=300):
    random.seed(seed)
    bits = ["x", '"', "\n", ",", "\n\n", "é", '""', " ", "long word " * 9, "\r\n", "a"]
    return [tuple("".join(random.choices(bits, k=random.randrange(5))) or None for _ in "abc") for _ in range(n)]


@pytest.mark.parametrize("seed", range(3))
def test_same_rows_in_many_tasks(spark, tmp_path, small_splits, seed):
    path = str(tmp_path / "t")
    write_csv(spark.createDataFrame(fields(seed), "a string, b string, c string").coalesce(2), path)
    found = read_csv_split(spark, path, SCHEMA)
    assert rows(found) == rows(read_csv(spark, path, SCHEMA))
    text = spark.read.text(path)
    assert text.select(F.spark_partition_id()).distinct().count() > 20
    assert records(spark, path).groupBy("file").agg(F.max("number").alias("n")).agg(F.sum("n")).first()[0] >= 302


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_breaks_ends_and_fields(spark, tmp_path, small_splits, end):
    """Fields over several splits, empty lines, rows of wrong length, no end of line at the end."""
    lines = ["a,b,c", '1,"' + (f"line{end}" * 200) + '",x', "", '2,"say ""hi""",', "3,short", "4,b,c,more", f'"5{end}","",c']
    (tmp_path / "t.csv").write_bytes(end.join(lines).encode())
    path = str(tmp_path / "t.csv")
    found = rows(read_csv_split(spark, path, SCHEMA))
    assert found == rows(read_csv(spark, path, SCHEMA)) and len(found) == 5


def test_header_is_checked_and_empty_files(spark, tmp_path):
    (tmp_path / "t.csv").write_text("a,b,x\n1,2,3\n")
    with pytest.raises(ValueError, match="header"):
        read_csv_split(spark, str(tmp_path / "t.csv"), SCHEMA)
    (tmp_path / "only.csv").write_text("a,b,c\n")
    (tmp_path / "none.csv").write_text("")
    for name in ("only", "none"):
        assert read_csv_split(spark, str(tmp_path / f"{name}.csv"), SCHEMA).count() == 0


def test_readers_keep_their_version(spark, tmp_path):
    path = str(tmp_path / "t")
    first = publish_snapshot(spark.range(10), path)
    held = read_published(spark, path)
    second = publish_snapshot(spark.range(25), path)
    assert (first.count(), held.count(), second.count()) == (10, 10, 25)
    assert read_published(spark, path).count() == 25 and read_published(spark, path, back=1).count() == 10
    publish_snapshot(spark.range(3), path)
    assert read_published(spark, path).count() == 3 and held.schema == first.schema
    folders = [p.name for p in (tmp_path / "t").iterdir() if p.name.startswith("v")]
    assert len(folders) == 2 and not any(f.startswith("v00000001") for f in folders)


def test_a_failed_version_is_never_seen(spark, tmp_path):
    path = str(tmp_path / "t")
    publish_snapshot(spark.range(4), path)
    broken = spark.range(5).select(F.when(F.col("id") == 4, F.raise_error(F.lit("lost"))).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="lost"):
        publish_snapshot(broken, path)
    assert read_published(spark, path).count() == 4
    # a table may be made from its own former version
    publish_snapshot(read_published(spark, path).unionAll(spark.range(2)), path, keep=1)
    assert read_published(spark, path).count() == 6
    assert len([p for p in (tmp_path / "t").iterdir() if p.name.startswith("v")]) == 1


def test_nothing_published(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="0 published"):
        read_published(spark, str(tmp_path / "t"))
    with pytest.raises(ValueError, match="at least"):
        publish_snapshot(spark.range(1), str(tmp_path / "t"), keep=0)
