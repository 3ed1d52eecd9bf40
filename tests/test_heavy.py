"""Exact modes without shuffling values, against the shuffle and plain counting."""

from __future__ import annotations

import datetime as dt
import json
import random
from collections import Counter
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from test_entry import run

from scrubline import functions as fn
from scrubline.operators import heavy
from scrubline.operators.impute import fit_bounded_modes, fit_modes

PLAIN = fn.NULL


def plain_mode(values):
    counts = Counter(v for v in values if v is not None)
    return min(((-n, v) for v, n in counts.items()), default=None)


def found(df, rule=PLAIN):
    return heavy.bounded_modes(df, {c: rule for c in df.columns})


def test_frequent_unique_tied_and_empty(spark):
    random.seed(1)
    rows = [
        (
            f"name {i}" if i % 10 else None,  # unique
            "often" if i % 3 == 0 else f"rare {i}",  # a third of all rows
            f"pair {i // 2:05d}",  # every value twice: ties
            random.choice(["a", "b"]) if i % 2 else "c" * 1000,  # a long mode
            None,
            i % 7,
        )
        for i in range(5000)
    ]
    df = spark.createDataFrame(rows, "u string, o string, p string, l string, e string, k int").repartition(7)
    got = found(df)
    for i, c in enumerate(df.columns):
        want = plain_mode(r[i] for r in rows)
        assert (got[c] and (-got[c].n, got[c].value)) == want, c
    assert {c: m and m.proof for c, m in got.items()} == {"u": "unique", "o": "counted", "p": "hashed", "l": "hashed", "e": None, "k": "counted"}


def test_types_zeros_and_odd_types(spark):
    rows = [
        (0.0, Decimal("1.10"), dt.date(2020, 1, 1), dt.datetime(2020, 1, 1), b"x", True, float("nan")),
        (-0.0, Decimal("1.10"), dt.date(2020, 1, 1), dt.datetime(2020, 1, 1), b"x", False, float("nan")),
        (1.0, Decimal("2.00"), dt.date(2021, 1, 1), dt.datetime(2021, 1, 1), b"y", False, 1.0),
    ]
    df = spark.createDataFrame(rows, "z double, d decimal(9,2), t date, s timestamp, b binary, o boolean, n double")
    got = found(df)
    shown = {c: (got[c].value, got[c].n) for c in df.columns if c != "n"}
    assert shown == {"z": (0.0, 2), "d": (Decimal("1.10"), 2), "t": (dt.date(2020, 1, 1), 2), "s": (dt.datetime(2020, 1, 1), 2),
                     "b": (b"x", 2), "o": (False, 2)}
    assert got["n"].n == 2 and got["n"].value != got["n"].value
    assert got["b"].proof == "shuffled"


def test_same_fill_values_under_each_rule(spark):
    df = spark.createDataFrame([("", "nan"), ("", "nan"), ("x", "1"), ("y", " ")], "a string, b string")
    for rule in (fn.NULL, fn.BLANK, fn.AUDIT, fn.Missing(allowed=("y", "1"))):
        rules = {c: rule for c in df.columns}
        assert fit_bounded_modes(df, rules) == fit_modes(df, rules)
    assert fit_bounded_modes(df.limit(0), {"a": fn.NULL}).value("a") is None
    assert fit_bounded_modes(df, {}).fills == ()


@pytest.mark.parametrize("seed", range(4))
def test_random_columns(spark, seed, monkeypatch):
    """Few proposals and buckets, so that every way is taken; nothing is lost."""
    random.seed(seed)
    monkeypatch.setattr(heavy, "PROPOSED", 1)
    monkeypatch.setattr(heavy, "BUCKETS", 3)
    rows = [(random.randrange(40), int(random.expovariate(0.1)), random.randrange(10**6)) for _ in range(600)]
    df = spark.createDataFrame(rows, "a int, b int, c int").repartition(5)
    got = found(df)
    assert [(-got[c].n, got[c].value) for c in df.columns] == [plain_mode(r[i] for r in rows) for i in range(3)]


def test_collisions_fall_back_to_the_shuffle(spark, monkeypatch):
    monkeypatch.setattr(heavy.F, "xxhash64", lambda c: F.lit(1).cast("bigint") + F.lit(0) * F.length(F.lit("x")))
    df = spark.createDataFrame([(f"v{i // 2}",) for i in range(200)], "v string")
    assert found(df)["v"] == heavy.Mode("v0", 2, "shuffled")


def test_a_unique_column_moves_little(tmp_path):
    """Bytes of all shuffles, from the event log of a session of its own."""
    code = f"""
from pyspark.sql import functions as F
from scrubline.functions import NULL
from scrubline.operators import heavy
from scrubline.session import build_session
spark = build_session("log", master="local[4]", spark__eventLog__enabled="true", spark__eventLog__dir="file://{tmp_path}",
    spark__eventLog__compress="false", spark__ui__showConsoleProgress="false", spark__sql__shuffle__partitions="8")
df = spark.range(300000).select(F.concat(F.sha2(F.col("id").cast("string"), 512), F.lit("name")).alias("u"),
    F.when(F.col("id") % 5 == 0, "often").otherwise(F.sha2(F.col("id").cast("string"), 512)).alias("o"))
print({{c: m.proof for c, m in heavy.bounded_modes(df, {{c: NULL for c in NAMES}}).items()}})
spark.stop()
"""
    moved = []
    for names, proof in ((["o"], "{'o': 'counted'}"), (["u"], "{'u': 'unique'}")):
        before = set(tmp_path.iterdir())
        assert run(code.replace("NAMES", str(names))).endswith(proof)
        log = next(iter(set(tmp_path.iterdir()) - before))
        files = log.iterdir() if log.is_dir() else [log]
        events = [json.loads(line) for f in files if "events" in f.name or f == log for line in f.open()]
        tasks = [e["Task Metrics"]["Shuffle Write Metrics"]["Shuffle Bytes Written"] for e in events if e["Event"] == "SparkListenerTaskEnd"]
        moved.append(sum(tasks))
    # values: 24 and 38 MB; hashes: 8 bytes each
    assert moved[0] < 1_000_000 and moved[1] < 300_000 * 24
