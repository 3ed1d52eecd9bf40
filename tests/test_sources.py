from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from scrubline import plans, sources
from scrubline.session import SETTINGS, shared_folder
from scrubline.sources import JdbcTarget, NameCollision

ROWS = [
    ("1", 'say "hi"', "two\nlines", " padded "),
    ("2", "comma, inside", "tab\there", ""),
    ("3", "é中😀", "\r\n", None),
]
SCHEMA = "`Review ID` string, `Said-It` string, `Text` string, Pad string"


def test_normal_names(spark):
    assert sources.normal_name("Content Rating") == "content_rating"
    assert sources.normal_name("A--b É") == "a__b__"
    df = spark.createDataFrame(ROWS, SCHEMA)
    assert sources.normalize_columns(df).columns == ["review_id", "said_it", "text", "pad"]
    clash = spark.createDataFrame([(1, 2, 3)], "`a-b` int, `a b` int, `A_B` int")
    with pytest.raises(NameCollision, match="a_b"):
        sources.normalize_columns(clash)


def test_csv_roundtrip(spark, tmp_path):
    df = spark.createDataFrame(ROWS, SCHEMA).coalesce(1)
    path = str(tmp_path / "csv")
    sources.write_csv(df, path)
    want = [(*r[:3], r[3] or None) for r in ROWS]
    for schema in (df.schema, None):
        back = sources.read_csv(spark, path, schema)
        assert [tuple(r) for r in back.orderBy("Review ID").collect()] == want


def test_csv_header_must_match_the_schema(spark, tmp_path):
    path = str(tmp_path / "csv")
    sources.write_csv(spark.createDataFrame([("1", "2")], "a string, b string"), path)
    with pytest.raises(Exception, match="(?i)header"):
        sources.read_csv(spark, path, sources.text_schema(["b", "a"])).collect()


@pytest.mark.parametrize("multi_line", [True, False])
def test_malformed_rows_are_found_or_refused(spark, tmp_path, multi_line):
    path = tmp_path / "t.csv"
    path.write_text('a,b\n1,x\n2\n3,"y, z"\n4,u,v\n,\n')
    schema = sources.text_schema(["a", "b"])
    found = sources.malformed_rows(spark, str(path), schema, str(tmp_path / "bad"), multi_line)
    assert found.columns == ["a", "b", "malformed_line"] and found.count() == 2
    rows = found.select("malformed_line", "a").orderBy("a").collect()
    assert [(r.malformed_line.strip(), r.a) for r in rows] == [("2", "2"), ("4,u,v", "4")]
    assert sources.read_csv(spark, str(path), schema, multi_line=multi_line).count() == 5
    with pytest.raises(Exception, match="(?i)malformed"):
        plans.land_csv(
            spark, str(path), str(tmp_path / "out"), ["a", "b"], multi_line, strict=True
        )


def test_csv_inference_is_optional(spark, tmp_path):
    path = str(tmp_path / "csv")
    sources.write_csv(spark.createDataFrame([("1.10", "x")], "ver string, b string"), path)
    assert sources.read_csv(spark, path).dtypes[0] == ("ver", "string")
    assert sources.read_csv(spark, path, infer=True).dtypes[0] == ("ver", "double")


def test_csv_without_line_breaks_can_be_split(spark, tmp_path):
    path = str(tmp_path / "csv")
    df = spark.range(1000).selectExpr("cast(id as string) a", "concat('v, ', id) b").coalesce(1)
    sources.write_csv(df, path)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        back = sources.read_csv(spark, path, df.schema, multi_line=False)
        assert back.rdd.getNumPartitions() > 1
        assert sorted(back.collect()) == sorted(df.collect())
        whole = sources.read_csv(spark, path, df.schema)
        assert whole.rdd.getNumPartitions() == 1
        assert sorted(whole.collect()) == sorted(df.collect())
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_land_csv(spark, tmp_path):
    df = spark.createDataFrame(ROWS, SCHEMA)
    sources.write_csv(df, str(tmp_path / "csv"))
    out = str(tmp_path / "table")
    landed = plans.land_csv(spark, str(tmp_path / "csv"), out, df.columns)
    assert landed.columns == ["review_id", "said_it", "text", "pad"]
    assert sorted(landed.collect()) == sorted(sources.read_snapshot(spark, out).collect())
    again = plans.land_csv(spark, str(tmp_path / "csv"), out)
    assert again.count() == 3


def test_snapshot_is_compressed_parquet(spark, tmp_path):
    path = tmp_path / "t"
    back = sources.write_snapshot(spark.range(10), str(path))
    assert back.count() == 10
    assert list(path.glob("*.snappy.parquet"))


def test_persisted_is_released(spark):
    df = spark.range(100)
    with sources.persisted(df) as kept:
        assert kept.count() == 100
        assert kept.storageLevel.useMemory and kept.storageLevel.useDisk
    assert not df.storageLevel.useMemory


def test_shared_folder(spark):
    root = spark.conf.get("spark.checkpoint.dir", None)
    folder, other = shared_folder(spark, "x"), shared_folder(spark, "x")
    assert "/x-" in folder and folder != other
    assert root is None or folder.startswith(root)


def test_results_of_two_round_trips_stay_readable(spark):
    """Each call writes a folder of its own."""
    from scrubline.checks import QUERIES

    for name in ("csv_roundtrip", "parquet_roundtrip"):
        first, second = (QUERIES[name](spark, "/root/testdata/sf0.001") for _ in range(2))
        assert first.count() == second.count() > 0


def test_a_cluster_needs_the_setting():
    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        conf = Conf()
        sparkContext = Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(Session(), "x")


def test_session_settings(spark):
    for key, value in SETTINGS.items():
        assert spark.conf.get(key) == value


# --- JDBC: what is sent; no database is started ------------------------------------


def test_jdbc_options():
    target = JdbcTarget("jdbc:x", driver="d", user="u", password="secret", connections=4)
    assert "secret" not in repr(target)
    assert target.write_options("t") == {
        "url": "jdbc:x", "driver": "d", "user": "u", "password": "secret", "dbtable": "t",
        "numPartitions": "4", "batchsize": "10000", "truncate": "true",
    }
    assert target.count_options("t")["query"] == "SELECT count(*) AS n FROM t"
    assert JdbcTarget("jdbc:x").connection() == {"url": "jdbc:x"}


def test_jdbc_ready_has_finite_numbers_only(spark):
    df = spark.createDataFrame([(float("nan"), "nan"), (1.0, "x")], "d double, s string")
    more = spark.createDataFrame([(float("inf"), "inf"), (float("-inf"), "y"), (None, "z")], df.schema)
    df = df.unionAll(more).withColumn("f", F.col("d").cast("float"))
    assert [tuple(r) for r in sources.jdbc_ready(df).collect()] == [
        (None, "nan", None), (1.0, "x", 1.0), (None, "inf", None), (None, "y", None),
        (None, "z", None),
    ]


def loaded_by(monkeypatch, found):
    """The frames that loads send, by mode, and a database with ``found`` rows."""
    from pyspark.sql.readwriter import DataFrameWriter
    from scrubline.sources import jdbc

    sent, mode, chosen = [], DataFrameWriter.mode, {}

    def remember(writer, name):
        chosen[id(writer)] = name
        return mode(writer, name)

    monkeypatch.setattr(DataFrameWriter, "mode", remember)
    monkeypatch.setattr(
        DataFrameWriter, "save", lambda writer: sent.append((chosen[id(writer)], writer._df))
    )
    monkeypatch.setattr(jdbc, "count_loaded", lambda *a: found)
    return sent


def test_load_sends_bounded_slices_and_checks_the_row_count(spark, tmp_path, monkeypatch):
    target = JdbcTarget("jdbc:x", connections=2, rows_per_file=10)
    frame = spark.range(95).repartition(3)
    sent = loaded_by(monkeypatch, 95)
    assert sources.load_table(frame, target, "t", str(tmp_path / "t")) == 95
    assert [mode for mode, _ in sent] == ["overwrite"] + ["append"] * (len(sent) - 1)
    counts = [part.count() for _, part in sent]
    assert sum(counts) == 95 and len(counts) >= 5 and max(counts) <= 20
    assert sorted(r.id for _, part in sent for r in part.collect()) == list(range(95))
    loaded_by(monkeypatch, 96)
    with pytest.raises(sources.LoadMismatch, match="95 rows sent, 96 found"):
        sources.load_table(frame, target, "t", str(tmp_path / "t"))


def test_an_empty_table_is_loaded_too(spark, tmp_path, monkeypatch):
    sent = loaded_by(monkeypatch, 0)
    empty = spark.range(0)
    assert sources.load_table(empty, JdbcTarget("jdbc:x"), "t", str(tmp_path / "t")) == 0
    assert sent[0][0] == "overwrite" and sent[0][1].columns == ["id"]
    assert [part.count() for _, part in sent] == [0] * len(sent)


def test_load_tables_names_and_stages_each_frame(spark, tmp_path, monkeypatch):
    from scrubline.plans import load

    seen = {}

    def fake(df, target, name, staging):
        seen[name] = staging
        return df.count()

    monkeypatch.setattr(load, "load_table", fake)
    frames = {"apps": spark.range(3), "reviews": spark.range(5)}
    counts = plans.load_tables(frames, JdbcTarget("jdbc:x"), "out", "_loading")
    assert counts == {"apps": 3, "reviews": 5}
    assert seen == {"apps_loading": "out/apps", "reviews_loading": "out/reviews"}
