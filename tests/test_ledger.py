"""Loads in which every row counts once, over frames in place of a database."""

from __future__ import annotations

from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from scrubline.sources import (
    LoadMismatch,
    each_once,
    landed_files,
    ledger,
    load_manifest,
    load_once,
    once_view,
    stage_files,
)
from scrubline.sources.ledger import CHECK, FILE, ROW, landed_query, read_staged

ROWS = 1000


@pytest.fixture
def table(spark):
    """Rows with gaps, odd numbers and many equal rows."""
    return spark.range(ROWS, numPartitions=3).select(
        F.when(F.col("id") % 3 > 0, F.col("id")).alias("key"),
        F.when(F.col("id") % 5 > 0, F.lit("same text")).alias("text"),
        (F.col("id") % 2 / 3).alias("share"),
        F.lit(b"\x00\xff").alias("raw"),
    )


@pytest.fixture
def staged(table, tmp_path):
    return stage_files(table, str(tmp_path / "staged"), rows_per_file=150)


class Frames:
    """A landing of frames; ``faults`` say what happens to each append."""

    def __init__(self, path, faults=()):
        self.path, self.faults, self.published = str(path), list(faults), None

    def append(self, rows):
        fault = self.faults.pop(0) if self.faults else "none"
        if fault == "lost":
            rows = rows.limit(0)
        elif fault == "half":
            rows = rows.where(F.col(ROW) % 2 == 0)
        elif fault == "changed":
            rows = rows.withColumn(CHECK, F.col(CHECK) + 1)
        for _ in range(2 if fault == "repeated" else 1):
            rows.write.mode("append").parquet(self.path)

    def rows(self, spark):
        return spark.read.parquet(self.path)

    def files(self, spark):
        return landed_files(self.rows(spark))

    def publish(self, manifest):
        self.published = sorted(r[FILE] for r in manifest.collect())


def counted(df, columns):
    return Counter(tuple(r) for r in df.select(columns).collect())


def same(df, table):
    return counted(df, table.columns) == counted(table, table.columns)


def test_entries_are_the_same_in_every_reading(spark, staged, table, tmp_path):
    again = read_staged(spark, staged.inputFiles()[::-1], table.schema)
    assert same(staged, again)
    assert staged.select(FILE, ROW).distinct().count() == ROWS
    manifest = load_manifest(staged).collect()
    assert sum(r.n_rows for r in manifest) == ROWS and len(manifest) == 9


def test_states(staged):
    manifest = load_manifest(staged)
    names = sorted(r[FILE] for r in manifest.select(FILE).collect())
    absent, partial, changed, repeated, *_ = names
    landed = staged.where(~F.col(FILE).isin(absent, partial, changed))
    landed = landed.unionAll(staged.where(F.col(FILE) == repeated))
    landed = landed.unionAll(staged.where((F.col(FILE) == partial) & (F.col(ROW) < 10)))
    landed = landed.unionAll(staged.where(F.col(FILE) == changed).withColumn(CHECK, F.col(CHECK) + 1))
    landed = landed.unionAll(staged.where(F.col(FILE) == names[-1]).withColumn(FILE, F.lit("other")))
    state = {r[FILE]: (r.state, r.landed_rows) for r in ledger(manifest, landed_files(landed)).collect()}
    assert state[absent] == ("absent", 0) and state[partial] == ("partial", 10)
    assert state[changed][0] == "damaged" and state["other"][0] == "foreign"
    assert state[repeated][0] == "complete" and state[repeated][1] == 2 * state[names[4]][1]
    assert [state[n][0] for n in names[4:]] == ["complete"] * 5


@pytest.mark.parametrize(
    "faults",
    [[], ["none", "repeated", "lost", "half"], ["none", "lost", "lost", "lost", "repeated"], ["none", "half", "repeated"]],
    ids=["plain", "mixed", "all-lost", "half-then-repeated"],
)
def test_load_counts_every_row_once(spark, table, tmp_path, faults):
    landing, seen = Frames(tmp_path / "db", faults), []
    manifest = load_once(
        table, landing, str(tmp_path / "staged"), 3, 150, on_attempt=lambda s: seen.append(s.where("state = 'complete'").count())
    )
    assert landing.published and seen[-1] == len(landing.published)
    assert same(each_once(landing.rows(spark), manifest), table)


def test_second_load_replaces_the_first(spark, table, tmp_path):
    landing = Frames(tmp_path / "db")
    load_once(table, landing, str(tmp_path / "one"), 3, 400)
    other = table.where("key > 500")
    manifest = load_once(other, landing, str(tmp_path / "two"), 3, 400)
    assert same(each_once(landing.rows(spark), manifest), other)


def test_damage_and_lasting_loss_publish_nothing(spark, table, tmp_path):
    for faults, text in ((["none", "changed"], "differ"), (["none"] + ["lost"] * 9, "missing")):
        landing = Frames(tmp_path / text, faults)
        with pytest.raises(LoadMismatch, match=text):
            load_once(table, landing, str(tmp_path / f"staged-{text}"), 3, 150)
        assert landing.published is None


def test_empty_table(spark, table, tmp_path):
    landing = Frames(tmp_path / "db")
    manifest = load_once(table.limit(0), landing, str(tmp_path / "staged"))
    assert landing.published == [] and each_once(landing.rows(spark), manifest).count() == 0


def test_ledger_names_are_kept_apart(table, tmp_path):
    with pytest.raises(ValueError, match="load_row"):
        stage_files(table.withColumn("Load_Row", F.lit(1)), str(tmp_path / "staged"))


def test_sql_of_the_database_side(spark, staged, tmp_path):
    """The statements a database gets, run by an engine in this process."""
    landed = staged.unionAll(staged.where(F.col(ROW) < 50))
    landed.write.parquet(str(tmp_path / "landing"))
    load_manifest(staged).write.parquet(str(tmp_path / "manifest"))
    con = duckdb.connect()
    for name in ("landing", "manifest"):
        con.sql(f"CREATE TABLE t_{name} AS SELECT * FROM '{tmp_path}/{name}/*.parquet'")
    columns = [FILE, "landed_rows", "n_rows", "checksum"]
    want = sorted(tuple(r) for r in landed_files(landed).select(columns).collect())
    assert sorted((a, int(b), c, int(d)) for a, b, c, d in con.sql(landed_query("t_landing")).fetchall()) == want
    view = con.sql(once_view("t", ["key", "text", "share"]))
    assert len(view.fetchall()) == ROWS
    assert con.execute(f"SELECT sum(key) FROM ({once_view('t', ['key'])})").fetchone()[0] == staged.agg(F.sum("key")).first()[0]
