"""Loading tables into a database over JDBC."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scrubline.functions.missing import is_finite, named


class LoadMismatch(RuntimeError):
    """The database table does not hold the rows that were sent."""


@dataclass(frozen=True)
class JdbcTarget:
    """A database and how hard to write to it.

    ``connections`` bounds the parallel writers whatever the cluster size, and
    ``rows_per_file`` the rows of a staged file, about what a transaction holds.
    The driver's jar comes to Spark by ``--jars``.
    """

    url: str
    driver: str | None = None
    user: str | None = None
    password: str | None = field(default=None, repr=False)
    connections: int = 16
    batch_size: int = 10_000
    rows_per_file: int = 1_000_000

    def connection(self) -> dict[str, str]:
        given = {
            "url": self.url,
            "driver": self.driver,
            "user": self.user,
            "password": self.password,
        }
        return {k: v for k, v in given.items() if v is not None}

    def write_options(self, table: str) -> dict[str, str]:
        """``truncate`` keeps the table's definition and grants on a rerun."""
        return self.connection() | {
            "dbtable": table,
            "numPartitions": str(self.connections),
            "batchsize": str(self.batch_size),
            "truncate": "true",
        }

    def count_options(self, table: str) -> dict[str, str]:
        return self.connection() | {"query": f"SELECT count(*) AS n FROM {table}"}


def jdbc_ready(df: DataFrame) -> DataFrame:
    """NaN and infinity become NULL in floating columns, as databases refuse them."""
    floating = (f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType)))
    return df.withColumns({n: F.when(is_finite(named(n)), named(n)) for n in floating})


def count_loaded(spark: SparkSession, target: JdbcTarget, table: str) -> int:
    reader = spark.read.format("jdbc").options(**target.count_options(table))
    return int(reader.load().first()[0])


def slices(files: list[str], connections: int) -> list[list[str]]:
    """The staged files in runs of one file for each connection; at least one run."""
    ordered = sorted(files)
    return [ordered[i : i + connections] for i in range(0, len(ordered), connections)] or [[]]


def load_table(df: DataFrame, target: JdbcTarget, table: str, staging: str) -> int:
    """Replace ``table`` by ``df`` and return the row count.

    ``df`` is written as parquet to ``staging``, a folder all executors share,
    in files of at most ``rows_per_file`` rows.  The load then takes as many
    files at a time as there are connections, so that a transaction is about one
    file and a failure repeats no more than that, whatever the table's size.  Each
    task commits on its own: one that is repeated after its commit (a lost
    executor, speculation) leaves its rows twice.  The count afterwards shows that,
    and a rerun starts from an empty table.

    Readers of ``table`` see it grow.  Load into a table of another name and let
    the database rename it when this returns.
    """
    jdbc_ready(df).write.mode("overwrite").option(
        "maxRecordsPerFile", target.rows_per_file
    ).parquet(staging)
    spark, schema = df.sparkSession, df.schema
    staged = spark.read.schema(schema).parquet(staging)
    options = target.write_options(table)
    for number, files in enumerate(slices(staged.inputFiles(), target.connections)):
        part = spark.read.schema(schema).parquet(*files) if files else staged
        mode = "append" if number else "overwrite"
        part.write.format("jdbc").options(**options).mode(mode).save()
    sent, loaded = staged.count(), count_loaded(spark, target, table)
    if sent != loaded:
        raise LoadMismatch(f"{table}: {sent} rows sent, {loaded} found; load it again")
    return loaded
