"""Loads in which every row counts once, whatever is repeated.

A JDBC task commits on its own, so a task that is repeated after its commit leaves its
rows twice, and a lost one may leave none.  Here every row carries its own ledger entry
into the database, in the same transaction as itself: the staged file it comes from, its
place in that file and a checksum.  Staged files do not change, so a repeated row has the
same entry and is known as a copy.

The manifest says how many rows and which checksum each staged file has.  What arrived is
compared with it, file by file, by one query that the database answers with one row a
file.  Files that are absent or incomplete are sent again.  The manifest goes to the
database last: the view of :func:`once_view` shows the rows of its files, each once, so
readers see the former load until the new one is whole.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scrubline.functions.missing import named
from scrubline.sources.jdbc import JdbcTarget, LoadMismatch, jdbc_ready, slices
from scrubline.sources.parquet import write_snapshot

FILE, ROW, CHECK = "load_file", "load_row", "load_check"
ENTRY = (FILE, ROW, CHECK)
# The parts of a floating number that count in a checksum.
STEP, WHOLE = 1e9, "decimal(38,0)"


def row_checksum(df: DataFrame) -> Column:
    """32 bits of the MD5 of a row's columns as text, which other engines can compute too.

    NULL differs from every text.  Floating numbers count in whole billionths; those
    beyond the range of decimals count by their sign only.
    """

    def text(field: T.StructField) -> Column:
        column = named(field.name)
        if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            double = column.cast("double")
            huge = F.when(double > 0, "huge").when(double < 0, "-huge").otherwise("nan")
            column = F.when(column.isNotNull(), F.coalesce((double * STEP).try_cast(WHOLE).cast("string"), huge))
        elif isinstance(field.dataType, T.BinaryType):
            column = F.hex(column)
        else:
            column = column.cast("string")
        return F.coalesce(F.concat(F.lit("="), column), F.lit("-"))

    digest = F.md5(F.concat_ws("\x1f", *(text(f) for f in df.schema)).cast("binary"))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")


def stage_files(df: DataFrame, staging: str, rows_per_file: int = 1_000_000) -> DataFrame:
    """Write ``df`` to ``staging`` and return its rows with their ledger entries.

    A row's place is its index within its parquet file, so every reading gives the
    same entries.
    """
    clash = sorted({*ENTRY} & {c.lower() for c in df.columns})
    if clash:
        raise ValueError(f"columns {clash} belong to the ledger")
    df.write.mode("overwrite").option("maxRecordsPerFile", rows_per_file).parquet(staging)
    return read_staged(df.sparkSession, staging, df.schema)


def read_staged(
    spark: SparkSession, paths: str | list[str], schema: T.StructType
) -> DataFrame:
    """Staged rows with their ledger entries, from a folder or from some of its files."""
    rows = spark.read.schema(schema).parquet(*([paths] if isinstance(paths, str) else paths))
    place = F.col("_metadata.file_name").alias(FILE), F.col("_metadata.row_index").alias(ROW)
    return rows.select("*", *place, row_checksum(rows).alias(CHECK))


def load_manifest(staged: DataFrame) -> DataFrame:
    """(load_file, n_rows, checksum) of every staged file that has rows; one row a file and task is shuffled."""
    return staged.groupBy(FILE).agg(F.count("*").alias("n_rows"), F.sum(CHECK).alias("checksum"))


def landed_files(landed: DataFrame) -> DataFrame:
    """(load_file, landed_rows, n_rows, checksum) of rows that arrived, copies apart.

    The same as :func:`landed_query`, for rows that Spark reads.
    """
    rows = landed.groupBy(*ENTRY).agg(F.count("*").alias("copies"))
    return rows.groupBy(FILE).agg(
        F.sum("copies").alias("landed_rows"), F.count("*").alias("n_rows"), F.sum(CHECK).alias("checksum")
    )


def landed_query(table: str) -> str:
    """SQL for :func:`landed_files`, answered by the database with one row a file."""
    entries = ", ".join(ENTRY)
    return (
        f"SELECT {FILE}, sum(copies) AS landed_rows, count(*) AS n_rows, sum({CHECK}) AS checksum "
        f"FROM (SELECT {entries}, count(*) AS copies FROM {table} GROUP BY {entries}) t GROUP BY {FILE}"
    )


def ledger(manifest: DataFrame, landed: DataFrame) -> DataFrame:
    """(load_file, sent_rows, landed_rows, state) of every file of either side.

    ``complete``: all its rows are there, copies or not.  ``absent`` and ``partial``: to
    be sent again.  ``damaged``: rows that were never sent under its name, or changed
    ones.  ``foreign``: a file of another load.
    """
    sent = manifest.select(FILE, F.col("n_rows").alias("sent_rows"), F.col("checksum").alias("sent_check"))
    both = sent.join(landed.select(FILE, "landed_rows", "n_rows", "checksum"), FILE, "full")
    same = (F.col("n_rows") == F.col("sent_rows")) & (F.col("checksum") == F.col("sent_check"))
    state = (
        F.when(F.col("sent_rows").isNull(), "foreign")
        .when(F.col("n_rows").isNull(), "absent")
        .when(same, "complete")
        .when(F.col("n_rows") < F.col("sent_rows"), "partial")
        .otherwise("damaged")
    )
    count = F.coalesce(F.col("landed_rows"), F.lit(0)).cast("bigint")
    return both.select(FILE, "sent_rows", count.alias("landed_rows"), state.alias("state"))


def each_once(landed: DataFrame, manifest: DataFrame) -> DataFrame:
    """The rows of the manifest's files without their entries, each once."""
    rows = landed.join(manifest.select(FILE), FILE, "left_semi").dropDuplicates([FILE, ROW])
    return rows.drop(*ENTRY)


def once_view(table: str, columns: Iterable[str]) -> str:
    """SQL of a query (for a view) over the landing table and its manifest."""
    names = ", ".join(columns)
    return (
        f"SELECT {names} FROM (SELECT {names}, {FILE}, row_number() OVER "
        f"(PARTITION BY {FILE}, {ROW} ORDER BY {CHECK}) AS load_copy FROM {table}_landing) t "
        f"WHERE load_copy = 1 AND {FILE} IN (SELECT {FILE} FROM {table}_manifest)"
    )


@dataclass(frozen=True)
class JdbcLanding:
    """The landing and manifest tables of ``table`` in a database."""

    target: JdbcTarget
    table: str

    def append(self, rows: DataFrame) -> None:
        options = self.target.write_options(f"{self.table}_landing")
        rows.write.format("jdbc").options(**options).mode("append").save()

    def files(self, spark: SparkSession) -> DataFrame:
        query = {"query": landed_query(f"{self.table}_landing")}
        return spark.read.format("jdbc").options(**self.target.connection(), **query).load()

    def publish(self, manifest: DataFrame) -> None:
        options = self.target.write_options(f"{self.table}_manifest")
        manifest.coalesce(1).write.format("jdbc").options(**options).mode("overwrite").save()


def load_once(
    df: DataFrame,
    landing,
    staging: str,
    connections: int = 16,
    rows_per_file: int = 1_000_000,
    attempts: int = 3,
    on_attempt: Callable[[DataFrame], None] | None = None,
) -> DataFrame:
    """Load ``df`` and return its manifest; every row counts once.

    Stages in ``staging`` and ``<staging>_manifest``, which all executors share.  ``landing`` is a :class:`JdbcLanding`, or anything with its three methods.  Files go
    ``connections`` at a time.  After each attempt the ledger (given to ``on_attempt``) says which
    files are to be sent again; damaged ones, or any left after ``attempts``, are an
    error, and the former load stays published.  Only names of files come to the driver.
    """
    ready = jdbc_ready(df)
    spark, schema = df.sparkSession, ready.schema
    staged = stage_files(ready, staging, rows_per_file)
    manifest = write_snapshot(load_manifest(staged), f"{staging}_manifest")
    rows = manifest.count()
    paths = {path.rsplit("/", 1)[-1]: path for path in staged.inputFiles()}
    # an empty first part makes the landing table
    landing.append(staged.limit(0))
    for _ in range(attempts):
        state = ledger(manifest, landing.files(spark)).where("state not in ('complete', 'foreign')")
        left = {r[FILE]: r["state"] for r in state.select(FILE, "state").collect()}
        if "damaged" in left.values():
            raise LoadMismatch(f"{sorted(f for f, s in left.items() if s == 'damaged')} differ from what was sent")
        if not left:
            break
        for part in slices([paths[f] for f in left], connections):
            landing.append(read_staged(spark, part, schema))
        if on_attempt:
            on_attempt(ledger(manifest, landing.files(spark)))
    final = ledger(manifest, landing.files(spark)).where("state = 'complete'")
    if final.count() != rows:
        raise LoadMismatch(f"files missing after {attempts} attempts")
    landing.publish(manifest)
    return manifest
