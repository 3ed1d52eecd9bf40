"""Reading one large CSV file with line breaks inside quotes in parallel.

Spark keeps such a file whole, as a split may begin inside a quoted field.  Here the file
is read as lines, which can be split anywhere.  In a field a quote is doubled, so a line
break is inside a field exactly if the number of quotes before it in the file is odd:

* within each split of the file, running sums say which lines begin a record if the split
  begins outside quotes, and which if it begins inside;
* sums over the splits, one row each, say which of the two it is and how many records
  began before;
* records of several lines are put together by number, and Spark's own parser reads each.

Lines that are a record of their own, usually nearly all, are not shuffled again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scrubline.sources.csv import DIALECT

QUOTE = DIALECT["quote"]


def _numbered(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(file, block, place, line, odd): lines with the split they are in and their order,
    and whether the quotes before them in their split are odd."""
    lines = spark.read.option("lineSep", "\n").text(paths).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        # rows of a split come in order and in one task
        F.monotonically_increasing_id().alias("place"),
        F.col("value").alias("line"),
    )
    quotes = F.length("line") - F.length(F.replace("line", F.lit(QUOTE), F.lit("")))
    in_split = Window.partitionBy("file", "block").orderBy("place")
    before = F.coalesce(F.sum("quotes").over(in_split.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counted = lines.withColumn("quotes", quotes)
    return counted.select("file", "block", "place", "line", "quotes", (before % 2 == 1).alias("odd"))


def _begins(inside: Column) -> Column:
    """Whether a line begins a record, given whether its split begins inside quotes."""
    return F.col("odd") == inside


def records(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(file, number, record): the records of CSV files, numbered from 1 in each file.

    Lines without any character outside a field are left out, as parsers do.
    """
    lines = _numbered(spark, paths)
    splits = lines.groupBy("file", "block").agg(
        (F.sum("quotes") % 2).alias("parity"),
        F.count_if(_begins(F.lit(False))).alias("outside"),
        F.count_if(_begins(F.lit(True))).alias("inside"),
        F.min_by(F.endswith("line", F.lit("\r")), "place").alias("crlf"),
    )
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    entered = splits.withColumn("entered", F.coalesce(F.sum("parity").over(earlier), F.lit(0)) % 2 == 1)
    begun = F.when(F.col("entered"), F.col("inside")).otherwise(F.col("outside"))
    of_file = Window.partitionBy("file").orderBy("block")
    based = entered.select(
        "file",
        "block",
        "entered",
        F.coalesce(F.sum(begun).over(earlier), F.lit(0)).alias("base"),
        # the first line of a file shows how its lines end
        F.first("crlf").over(of_file).alias("crlf"),
    )
    in_split = Window.partitionBy("file", "block").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    first = _begins(F.col("entered"))
    numbered = lines.join(based, ["file", "block"]).select(
        "file",
        "block",
        "place",
        F.when(F.col("crlf"), F.regexp_replace("line", "\r$", "")).otherwise(F.col("line")).alias("line"),
        (F.col("base") + F.sum(first.cast("int")).over(in_split)).alias("number"),
        # begins outside quotes and ends outside quotes
        (first & (F.col("quotes") % 2 == 0)).alias("whole"),
    )
    single = numbered.where("whole").select("file", "number", F.col("line").alias("record"))
    part = F.struct("block", "place", "line")
    parts = numbered.where("not whole").groupBy("file", "number").agg(F.array_sort(F.collect_list(part)).alias("parts"))
    several = parts.select("file", "number", F.array_join(F.col("parts.line"), "\n").alias("record"))
    return single.unionAll(several).where("record <> ''")


def read_csv_split(spark: SparkSession, paths: str | list[str], schema: T.StructType) -> DataFrame:
    """Like :func:`~scrubline.sources.csv.read_csv` with a schema, but a file is read in
    as many tasks as it has splits.

    For files whose quotes are well formed: a field with a quote in it is quoted and the quote
    doubled, as the dialect has it.  The order of the rows is not kept.
    """
    found = records(spark, paths)
    names = F.col("number") == 1
    header = T.StructType([T.StructField(f.name, T.StringType()) for f in schema])
    options = {k: v for k, v in DIALECT.items() if k != "header"}

    def parsed(rows: DataFrame, as_type: T.StructType) -> DataFrame:
        row = F.from_csv("record", as_type.toDDL(), options | {"mode": "PERMISSIVE"})
        return rows.select(row.alias("row")).select("row.*")

    for given in parsed(found.where(names), header).distinct().limit(2).collect():
        if list(given) != schema.names:
            raise ValueError(f"header {list(given)} is not {schema.names}")
    return parsed(found.where(~names), schema)
