"""Audits that cost no pass of their own: counted while a snapshot is written.

``DataFrame.observe`` counts in the tasks that write.  Of a task that writes, the counts
are taken once, however often it is tried.  A stage before a shuffle counts again when its
lost output is made again.  So ``narrow`` says that there is no shuffle; without it the
rows that come out are counted the same way and compared with those of the written
files, which their footers know without a scan: a stage that counted twice shows
there too, and the audit then makes a pass of its own.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from scrubline.functions.convert import is_non_numeric, percentage
from scrubline.functions.missing import AUDIT, Missing, count_where, is_missing, named
from scrubline.operators.audit import ROWS
from scrubline.sources.parquet import write_snapshot

Counts = dict[str, int]


def observed_snapshot(
    df: DataFrame,
    path: str,
    counts: Mapping[str, Column],
    then: Callable[[DataFrame], DataFrame] = lambda df: df,
    narrow: bool = False,
) -> tuple[DataFrame, Counts]:
    """Write ``then(df)`` to ``path``; the snapshot, and ``counts`` and ``__rows`` over ``df``.

    ``counts`` are aggregates that count, over columns of ``df``.
    """
    wanted = {ROWS: F.count("*"), **counts}
    before, after = Observation(), Observation()
    parts = [c.alias(f"n{i}") for i, c in enumerate(wanted.values())]
    watched = then(df.observe(before, *parts))
    snapshot = write_snapshot(watched.observe(after, F.count("*").alias(ROWS)), path)
    found, out = before.get, after.get
    if not narrow and out[ROWS] != snapshot.count():
        found = df.agg(*parts).first().asDict()
    return snapshot, {name: found[f"n{i}"] for i, name in enumerate(wanted)}


def missing_parts(
    df: DataFrame,
    columns: Iterable[str],
    prefix: str = "",
    rule: Missing = AUDIT,
    where: Column | None = None,
) -> dict[str, Column]:
    """Counts of missing values, named by ``prefix`` and column."""
    chosen = F.lit(True) if where is None else where
    return {f"{prefix}{c}": count_where(chosen & is_missing(df, c, rule)) for c in columns}


def non_numeric_parts(columns: Iterable[str], prefix: str, where: Column) -> dict[str, Column]:
    return {f"{prefix}{c}": count_where(where & is_non_numeric(named(c))) for c in columns}


def is_complete(df: DataFrame, rules: Mapping[str, Missing]) -> Column:
    """Predicate: none of the columns in ``rules`` is missing."""
    return ~reduce(or_, (is_missing(df, c, r) for c, r in rules.items()))


def count_table(spark: SparkSession, rows: Iterable[tuple], schema: str) -> DataFrame:
    """A small table of counts that are known."""
    fields = [part.strip().split(" ") for part in schema.split(",")]
    structs = [F.struct(*(F.lit(v).cast(t).alias(n) for v, (n, t) in zip(row, fields))) for row in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))


def percentage_table(spark: SparkSession, counts: Counts, columns: Iterable[str], prefix: str = "", rows: str = ROWS) -> DataFrame:
    """(column, missing, pct) from counts; 0 % for an empty table."""
    found = count_table(
        spark, ((c, counts[f"{prefix}{c}"], counts[rows]) for c in columns), "column string, missing bigint, rows bigint"
    )
    return found.select("column", "missing", percentage(F.col("missing"), F.col("rows")).alias("pct"))


def snapshot_with_audit(
    df: DataFrame, path: str, columns: Iterable[str] | None = None, rule: Missing = AUDIT
) -> tuple[DataFrame, DataFrame]:
    """Write ``df``; the snapshot, and (column, missing, pct) as
    :func:`~scrubline.operators.audit.missing_percentages` has it, without another pass."""
    names = list(df.columns if columns is None else columns)
    snapshot, counts = observed_snapshot(df, path, missing_parts(df, names, "", rule))
    return snapshot, percentage_table(df.sparkSession, counts, names)
