"""Benchmark decontamination against brute force."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from scrubline.llm import decontaminate

RUN = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
UPPER = {c: c + 32 for c in range(65, 91)}


def words(text):
    return RUN.findall((text or "").translate(UPPER))


def brute(docs, items, window=10):
    """(doc_id, n_words, n_hit, items) of each document."""
    parts = []
    for ident, text in items:
        w = words(text)
        parts += [("" if ident is None else str(ident), w[i : i + window]) for i in range(max(1, len(w) - window + 1)) if w]
    out = []
    for ident, text in docs:
        w = words(text)
        hit, found = set(), set()
        for item, p in parts:
            for i in range(len(w) - len(p) + 1):
                if w[i : i + len(p)] == p:
                    hit.update(range(i, i + len(p)))
                    found.add(item)
        out.append((ident, len(w), len(hit), sorted(found)))
    return sorted(out, key=str)


def ours(spark, docs, items, **how):
    docs = spark.createDataFrame([(*d, 0, "x", 1, "k") for d in docs], "doc_id long, text string, n long, w string, at int, key string")
    items = spark.createDataFrame([(*i, "y", 2) for i in items], "item_id long, text string, window string, n int")
    found = decontaminate.contamination(docs, items, ["doc_id"], **how)
    return sorted([tuple(r) for r in found.select("doc_id", "n_words", "n_hit", "items").collect()], key=str)


def random_tables(seed):
    random.seed(seed)
    letters = ["a", "B", "c1", "Ä", "é", "0"]
    items = [(i, " ".join(random.choices(letters, k=random.choice([1, 2, 3, 5, 9, 10, 11, 14, 30])))) for i in range(25)]
    docs = []
    for i in range(60):
        text = random.choices(letters, k=random.randrange(60))
        for _, part in random.sample(items, 2):
            at = random.randrange(len(text) + 1)
            text[at:at] = part.lower().split() if i % 2 else part.split()[:12]
        docs.append((i, random.choice([" ", ", ", "\n-"]).join(text)))
    return docs, items


@pytest.mark.parametrize("broadcast_mb", [64, 0])
@pytest.mark.parametrize("window,shingle", [(10, 4), (5, 5), (3, 1)])
def test_brute_force(spark, broadcast_mb, window, shingle):
    docs, items = random_tables(window)
    assert ours(spark, docs, items, window=window, shingle=shingle, broadcast_mb=broadcast_mb) == brute(docs, items, window)


ODD_ITEMS = [(7, "one two three"), (7, "four five"), (None, "lone ITEM"), (8, None), (9, " ?! "), (10, "one two three"), (11, "a b c d e f g h i j k")]
ODD_DOCS = [(1, None), (2, ""), (3, "--"), (4, "One, two: THREE four five"), (4, "One, two: THREE four five"), (None, "x lone item y"),
            (5, "a b c d e f g h i j a b c d e f g h i j k"), (6, "w " * 30_000 + "one two three " + "w " * 30_000), (7, "one two thre")]


@pytest.mark.parametrize("broadcast_mb", [64, 0])
def test_odd_rows(spark, broadcast_mb):
    found = ours(spark, ODD_DOCS, ODD_ITEMS, broadcast_mb=broadcast_mb)
    assert found == brute(ODD_DOCS, ODD_ITEMS)
    assert (4, 5, 5, ["10", "7"]) in found and (None, 4, 2, [""]) in found and (5, 21, 21, ["11"]) in found


def test_empty_tables(spark):
    assert ours(spark, [], ODD_ITEMS) == []
    assert ours(spark, ODD_DOCS[:4], []) == [(1, 0, 0, []), (2, 0, 0, []), (3, 0, 0, []), (4, 5, 0, [])]
    assert ours(spark, ODD_DOCS[:1], ODD_ITEMS[3:5]) == [(1, 0, 0, [])]


def test_copies_and_hot_windows(spark):
    docs = [(i, "start one two three end" if i % 3 else f"other {i} one two") for i in range(600)]
    assert ours(spark, docs, ODD_ITEMS) == brute(docs, ODD_ITEMS)


def test_no_python_in_the_plan(spark):
    """The dealt style is native: no Python worker and no cross join."""
    docs = spark.createDataFrame(ODD_DOCS, "doc_id long, text string")
    items = spark.createDataFrame(ODD_ITEMS, "item_id long, text string")
    plan = decontaminate.contamination(docs, items, ["doc_id"])._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas|Cartesian|NestedLoop", plan)


def test_registered_query(spark):
    from scrubline.llm.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
    want = [(d, n, hit, len(i), hashlib.sha256(",".join(i).encode()).hexdigest(), hit > 0) for d, n, hit, i in brute(docs, items)]
    got = QUERIES["op11_benchmark_decontamination"](spark, sf)
    assert got.columns == ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    assert sorted([tuple(r) for r in got.collect()], key=str) == sorted(want, key=str)
    assert got.filter(F.col("contaminated")).count() > 0
