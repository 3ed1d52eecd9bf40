"""The operators against brute force, and on nulls, empties, ties and repeats."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from scrubline.llm import common, exact, licences, lm_bloom, mixing, neighbours, packing, quality, simhash, token_counts, url_lists
from scrubline.llm.components import components
from scrubline.llm.oracle import ORACLE
from scrubline.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
ODD = [(1, "a  b\tc", "en", "s1"), (2, None, None, None), (3, "", "en", "s1"), (3, "", "en", "s1"), (None, "a b c", "de", "s2"),
       (4, " \n ", "en", None), (5, "w " * 30_000, "fr", "s2"), (5, "x", None, "s1")]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, at int, row string, id string, fp string"


@pytest.fixture(scope="module")
def odd(spark):
    """Odd rows, with columns named like the operators' own."""
    return spark.createDataFrame([(*r, 0, 1, "r", "i", "f") for r in ODD], SCHEMA)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def rows(df):
    return [tuple(r) for r in df.collect()]


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark"):
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    ours, theirs = QUERIES[name](spark, SF), con.sql(ORACLE[name])
    names = sorted(ours.columns)
    assert names == sorted(theirs.columns)
    got = sorted(rows(ours.select(*names)), key=str)
    want = sorted(con.sql(f"select {', '.join(names)} from theirs").fetchall(), key=str)
    assert got == want


def test_exact_odd_rows(odd):
    found = rows(exact.exact_duplicates(odd).select("doc_id", "keep_id", "group_size", "kept"))
    assert Counter(found) == Counter([
        (1, 1, 2, True), (None, 1, 2, False), (2, 2, 3, True), (3, 2, 3, False), (3, 2, 3, False),
        (4, 4, 1, True), (5, 5, 1, True), (5, 5, 1, True),
    ])
    kept = exact.drop_exact_duplicates(odd)
    assert kept.columns == odd.columns and kept.count() == 5
    assert exact.drop_exact_duplicates(odd.limit(0)).count() == 0


def test_exact_hot_text(spark):
    many = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 > 0, "hot text").otherwise(F.col("id").cast("string")).alias("text"))
    found = exact.exact_duplicates(many)
    assert found.filter("kept").count() == 1001
    assert rows(found.filter("group_size > 1").select("keep_id", "group_size").distinct()) == [(1, 2000)]


def test_fingerprint():
    import xxhash

    text = "Ä b C d\te b c d e"
    words = text.encode().lower().split()
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + 4]), 42) for i in range(len(words) - 3)]
    want = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    assert simhash.fingerprint(text.encode()) == want
    assert simhash.fingerprint(None) == simhash.fingerprint(b" ") == 0


def test_links_are_complete(spark):
    random.seed(3)
    fps = [random.getrandbits(64) for _ in range(300)]
    for _ in range(5):
        fps += [f ^ (1 << random.randrange(64)) ^ (1 << random.randrange(64)) for f in random.sample(fps, 150)]
    fps = np.array(sorted(set(fps)), np.uint64)
    points = spark.createDataFrame([(int(x),) for x in fps.view(np.int64)], "fp long")
    found = dict(rows(components(simhash.fingerprint_links(points, 4))))
    got = np.array([found.get(int(x), int(x)) for x in fps.view(np.int64)])
    near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 4
    want = fps.view(np.int64).copy()
    while not np.array_equal(new := np.array([want[n].min() for n in near]), want):
        want = new
    assert np.array_equal(got, want)


def test_near_duplicates_odd_rows(odd):
    found = rows(simhash.near_duplicates(odd, ["doc_id"]).select("doc_id", "component_id"))
    assert Counter(found)[(3, 2)] == 2 and (4, 2) in found and (None, 1) in found and len(found) == len(ODD)
    kept = simhash.keep_one_of_each(odd)
    assert kept.columns == odd.columns and Counter(r.doc_id for r in kept.collect())[2] == 1
    assert simhash.keep_one_of_each(odd.limit(0)).count() == 0


def test_near_duplicates_are_grouped_by_component(spark):
    words = [f"word{i}" for i in range(200)]
    near = [" ".join(words), " ".join([*words[:-1], "other"])]
    one_id = [(5, "alpha beta gamma delta epsilon zeta"), (5, "one two three four five six seven")]
    df = spark.createDataFrame([*one_id, *[(None, t) for t in near]], "doc_id long, text string")
    prints = [simhash.fingerprint(t.encode()) for t in near]
    assert prints[0] != prints[1] and (prints[0] ^ prints[1]).bit_count() <= 4
    kept = [r.text for r in simhash.keep_one_of_each(df).collect()]
    assert {t for _, t in one_id} <= set(kept) and len(kept) == 3


def test_targets():
    assert mixing.targets([10, 100, 100], [1, 2, 3]) == pytest.approx([30, 72, 108])
    assert mixing.targets([0, 0], [1, 2]) == [0, 0] and mixing.targets([], []) == []


def test_mix(spark, docs, odd):
    found = mixing.mix(docs, [1, 2, 3]).join(docs.select("doc_id", "source"), "doc_id").toPandas()
    assert (found["taken"] <= 3 * found["size"]).all()
    by = found.groupby("source").agg(size=("size", "sum"), target=("target", "max"), taken=("taken", "sum"))
    assert (abs(by["taken"] / by["target"] - 1) < 0.05).all() and by["target"].sum() == pytest.approx(by["size"].sum())
    again = mixing.mix(docs.repartition(7), [1, 2, 3]).toPandas().sort_values("doc_id")
    assert again["taken"].tolist() == found.sort_values("doc_id")["taken"].tolist()
    mixed = mixing.mixed_documents(docs, [1, 2, 3])
    assert mixed.columns == docs.columns
    assert sum(len(r.text.split()) for r in mixed.collect()) == found["taken"].sum()
    assert mixing.mix(odd, [1, 2, 3]).count() == len(ODD) and mixing.mix(odd.limit(0), [1, 2, 3]).count() == 0
    assert mixing.mixed_documents(odd, [1, 2, 3]).columns == odd.columns


@pytest.mark.parametrize("n", [*range(1, 40), 99, 100, 101, 1000, 10_007])
def test_permutations(spark, n):
    i, size = F.col("id"), F.lit(n).cast("long")
    keys = [(F.lit("a"), F.lit(0)), (F.lit("a"), F.lit(1)), (F.lit("b"), F.lit(0))]
    found = [sorted(c) for c in zip(*rows(spark.range(n).select(*(mixing.permuted(i, size, *k) for k in keys))))]
    assert found == [list(range(n))] * 3


def undone(y, n, rounds_of):
    """The number that ``permuted`` sends to ``y``, by going the rounds back."""
    import math

    high = math.ceil(math.sqrt(n))
    low = -(-n // high)
    while True:
        left, right = divmod(y, low)
        for step in range(mixing.ROUNDS - 2, -1, -2):
            right = (right - rounds_of(left, step + 1) % low) % low
            left = (left - rounds_of(right, step) % high) % high
        y = left * low + right
        if y < n:
            return y


@pytest.mark.parametrize("n", [5_000_000_000, 1_000_000_000_000])
def test_permutations_of_many(spark, n):
    """No overflow, and the rounds can be undone, so no two numbers meet."""
    import struct

    import xxhash

    def rounds_of(value, step):  # as the engine hashes a long and an int, one after the other
        first = xxhash.xxh64_intdigest(struct.pack("<q", value), 42)
        h = xxhash.xxh64_intdigest(struct.pack("<i", step), first)
        return h - (1 << 64) if h >= 1 << 63 else h

    places = spark.range(0, n, n // 400).select("id", mixing.permuted(F.col("id"), F.lit(n).cast("long")).alias("y"))
    found = rows(places)
    assert all(0 <= y < n for _, y in found) and len({y for _, y in found}) == len(found)
    assert [undone(y, n, rounds_of) for _, y in found] == [i for i, _ in found]


def test_shard_counts(spark):
    """Sources' totals are their targets; the counts of shards spread as draws do."""
    slots = {"a": 3000.2, "b": 12_000.0, "c": 45_000.4, "d": 0.0}
    plan = [{"src": s, "blocks": 20_000, "slots": n} for s, n in slots.items()]
    found = mixing.shard_counts(spark, plan, shard=300).toPandas()
    assert found.groupby("src")["n"].sum().to_dict() == {"a": 3000, "b": 12_000, "c": 45_000}
    wide = found.pivot(index="shard", columns="src", values="n").fillna(0)
    assert len(wide) == 200 and (wide.sum(axis=1) == 300).all()
    expected = np.array([3000, 12_000, 45_000]) / 200
    chi = (((wide - expected) ** 2) / expected).to_numpy().sum()
    # 199 x 2 degrees of freedom: mean 398, deviation 28
    assert 398 - 4 * 28.2 < chi < 398 + 4 * 28.2
    for _, own in found.sort_values("shard").groupby("src"):
        assert (own["first"] == own["n"].cumsum() - own["n"]).all()
    assert (mixing.block_uses(spark, plan, 300).toPandas()["uses"] <= 3).all()


def test_many_sources(spark):
    many = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("a b c d e").alias("text"), F.concat(F.lit("s"), "id").alias("source"))
    found = mixing.mix(many, [1, 2, 3]).agg(F.sum("taken"), F.count(F.lit(1)), F.max("taken")).first()
    assert found[0] == 15_000 and found[1] == 3000 and found[2] <= 15


def test_packing(spark, docs, odd):
    from tokenizers import Tokenizer

    exact_ids = Tokenizer.from_file(packing.tokenizer_files()["vocabulary"])
    found = packing.packed_documents(docs, ids=True).toPandas()
    texts = {r.doc_id: r.text for r in docs.collect()}
    for doc_id, group in found.sort_values("piece").groupby("doc_id"):
        want = exact_ids.encode(texts[doc_id] or "", add_special_tokens=False).ids + [2]
        assert [t for part in group["ids"] for t in part] == want
        assert (group["length"].iloc[1:] == 1024).all()
    assert all(zlib.crc32(np.array(p, "<u4").tobytes()) == c for p, c in zip(found["ids"], found["ids_crc32"]))
    placed = found.sort_values(["sequence_id", "offset"])
    assert (placed.groupby("sequence_id")["length"].cumsum() - placed["length"] == placed["offset"]).all()
    sizes = found.groupby("sequence_id")["length"].sum()
    assert sizes.max() <= 1024 and len(sizes) <= math.ceil(found["length"].sum() / 1024) + 2
    assert packing.packed_documents(odd).filter("doc_id = 3 and length = 1").count() == 2
    assert packing.packed_documents(odd.limit(0)).count() == 0


def test_fullest_is_optimal():
    random.seed(1)
    for _ in range(50):
        lengths = [random.randint(1, 30) for _ in range(8)]
        used = packing.fullest(dict(Counter(lengths)), 40)
        rest = sorted(lengths)[:-1]
        sums = {sum(x for i, x in enumerate(rest) if m >> i & 1) + max(lengths) for m in range(1 << len(rest))}
        assert sum(a * n for a, n in used) == max(s for s in sums if s <= 40)


def test_both_tokenizers_split_alike():
    files = packing.tokenizer_files()
    encode = packing.encoder(**files)
    exact_ids, _ = packing.load(**files)
    for low in range(32, 0x250, 16):
        text = " ".join(f"a{chr(c)}b {chr(c)}{chr(c)} 1{chr(c)}" for c in range(low, low + 16))
        assert encode(text).tolist() == exact_ids.encode(text, add_special_tokens=False).ids


def test_quality(spark, docs, odd):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    found = quality.classify(docs, labels, ["doc_id"]).join(labels, "doc_id").toPandas()
    assert found.loc[found["quality"] == 1, "keep"].mean() > 0.95 and found.loc[found["quality"] == 0, "keep"].mean() < 0.3
    kept = quality.keep_good(odd, labels)
    assert kept.columns == odd.columns and kept.filter("doc_id = 3").count() == 2
    assert quality.keep_good(odd, labels.limit(0)).count() == len(ODD)
    assert quality.keep_good(odd.limit(0), labels).count() == 0


def test_quality_of_short_texts(spark):
    random.seed(4)
    good = [" ".join(random.choices(["we", "go", "to", "the", "old", "house", "again", "."], k=n)) for n in [*range(1, 15)] * 12 + [60] * 60]
    junk = ["q## zz&&& x9x9 | ~~", "@@ || %% 77&& $$$$ ##q", "Re*** ha$$$ an&&& 0| | ;;- q%q% ** ^^ |||"]
    rows = [(i, t, "en") for i, t in enumerate(good)] + [(1000 + i, t, "en") for i, t in enumerate(junk)] + [(2000, "", "en")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1) for i in range(len(good))], "doc_id long, quality int")
    kept = {r.doc_id for r in quality.classify(df, labels, ["doc_id"]).filter("keep").collect()}
    assert not kept & {1000, 1001, 1002} and 2000 in kept
    assert len(kept & set(range(len(good)))) >= 0.97 * len(good)


def test_kneser_ney_probabilities_add_up(spark):
    text = "a b a c a b b c a . " * 20
    tables = quality.train(spark.createDataFrame([(text,), ("b c a a b",)], "text string"))
    model = quality.Model(tables)
    words = quality.hashed([b"a", b"b", b"c", b"."])
    from scrubline.llm.ngrams import END

    total = sum(10 ** model.log10(np.array([model.words(b"a b")[0], model.words(b"a b")[1], k]), np.array([3]))[2] for k in [*words, END])
    # what is missing to one is the share of an unknown word
    assert 1 - tables["unknown"] <= total <= 1 + 1e-6


def test_repeated_words_are_unlikely(spark):
    """The third and later of equal words count as unknown, whatever was trained."""
    zeros = "0 0 0 0 0 0 0 0 ."
    model = quality.Model(quality.train(spark.createDataFrame([(f"{zeros} {w} b c a b c .",) for w in "abc" * 15], "text string")))
    p = [10 ** model.log10(model.words(t), np.array([len(t.split())])) for t in (zeros.encode(), b"0 0 .")]
    assert (p[0][2:8] < 0.1).all() and (p[0][:2] == p[1][:2]).all() and p[0][1] > 0.5


def _kneser_ney(texts, steps, words):
    """The log10 probability of a text, counted with dictionaries."""
    from scrubline.llm.ngrams import END, START

    def grams(text):
        keys = [START, START, *words(text.encode()).tolist(), END]
        return [tuple(int(k) for k in keys[i - 2 : i + 1]) for i in range(2, len(keys))]

    third = Counter(g for t in texts for g in grams(t) if g[2] != quality.REPEATED)
    counts = [third, Counter(g[1:] for g in third)]
    counts.append(Counter(g[1:] for g in counts[1]))
    counts.reverse()
    sums, less = [Counter() for _ in counts], [Counter() for _ in counts]
    for i, table in enumerate(counts):
        for g, n in table.items():
            sums[i][g[:-1]] += n
            less[i][g[:-1]] += steps[i][min(n, 3)]

    def log10(text):
        total = 0
        for g in grams(text):
            p = 1 / (len(counts[0]) + 1)
            for i in range(3):
                h = g[2 - i :]
                if s := sums[i][h[:-1]]:
                    p = (counts[i][h] - steps[i][min(counts[i][h], 3)] + less[i][h[:-1]] * p) / s
            total += math.log10(p)
        return total

    return log10


def _trusted_texts():
    random.seed(8)
    vocabulary = ["the", "house", "is", "old", "Iron", "77", "x-9", "and", "."]
    texts = [" ".join(random.choices(vocabulary, k=n)) for n in [1, 2, 3, 4, 9, 30, 60] * 6]
    return [*texts, "and and and and and .", "a text that comes twice .", "a text that comes twice .", "odd## WORD", ""]


@pytest.mark.parametrize("broadcast_mb", [64, 0], ids=["sent", "segments"])
def test_model_counts_every_trusted_text(spark, broadcast_mb):
    """Both ways to the table against dictionaries, with and without a text's own part."""
    texts = _trusted_texts()
    copies = Counter(texts)
    rows = [(i, t, copies[t]) for i, t in enumerate(texts)] + [(100, "the iron 99 house", None), (101, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, copies long")
    trusted = df.filter("copies is not null").repartition(3)
    found = quality.with_perplexity(df.repartition(3), ["doc_id"], trusted, broadcast_mb=broadcast_mb).collect()
    tables = quality.train(trusted)
    words, steps = quality.Words(tables["frequent"]), tables["steps"]
    assert sorted(r.doc_id for r in found) == [r[0] for r in rows]
    for r in found:
        text = dict((i, t or "") for i, t, _ in rows)[r.doc_id]
        want = _kneser_ney(texts, steps, words)(text)
        assert math.isclose(r.perplexity, 10 ** (-want / r.n_tokens), rel_tol=1e-9)
        if r.doc_id < 100:
            want = _kneser_ney([t for t in texts if t != text], steps, words)(text)
            assert math.isclose(r.without, 10 ** (-want / r.n_tokens), rel_tol=1e-9), text
        else:
            assert r.without is None


def test_classifier_learns_from_every_trusted_row(spark):
    """Long texts, repeated rows and all of a language, judged by the model of all."""
    texts = _trusted_texts()
    random.seed(9)
    long = " ".join(random.choices(["long", "words", "of", "a", "report"], k=12_000))
    rows = [(i, t, "en") for i, t in enumerate(texts)] + [(90, long, "de"), (91, "one row twice .", None), (91, "one row twice .", None)]
    others = [(100, "the iron 99 house", "en"), (101, None, "en"), (None, "the house", "en"), (102, "one row twice .", "fr")]
    df = spark.createDataFrame(rows + others, "doc_id long, text string, lang string")
    labels = [(r[0], q) for r in rows[:-1] for q in (0, 1)] + [(100, 0), (101, 1)]
    found = quality.classify(df, spark.createDataFrame(labels, "doc_id long, quality int"), ["doc_id", "text"]).collect()
    trusted = [r[1] for r in rows]
    assert len(long) > 50_000 and len(found) == len(rows) + len(others)
    tables = quality.train(spark.createDataFrame([(t,) for t in trusted], "text string"))
    log10 = _kneser_ney(trusted, tables["steps"], quality.Words(tables["frequent"]))
    for r in found:
        assert math.isclose(r.perplexity, 10 ** (-log10(r.text or "") / r.n_tokens), rel_tol=1e-9), r.doc_id


def test_small_tables_are_few_files(spark):
    """However many partitions they come in, as each file costs the executor that writes it."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = components(spark.createDataFrame([(i, i + 1) for i in range(60)], "a long, b long"))
        assert sorted(map(tuple, found.collect())) == [(i, 0) for i in range(1, 61)] and len(found.inputFiles()) == 1
        table, _ = quality.count(spark.createDataFrame([(t,) for t in _trusted_texts()], "text string").repartition(3))
        assert len(table.inputFiles()) == 1
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    many = common.stage(spark.range(100_000).repartition(8), "many", at_most=100_000)
    assert many.count() == 100_000 and len(many.inputFiles()) == 2


def test_workers_do_not_keep_the_model(spark):
    texts = _trusted_texts()
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, copies long")
    assert quality.with_perplexity(df.repartition(8), ["doc_id"], df).count() == len(texts)

    def held(batches):
        import sys

        for batch in batches:
            worker = vars(sys.modules.get("_scrubline_llm_worker", object))
            yield pa.RecordBatch.from_arrays([pa.array([str(worker.get("key"))] * batch.num_rows)], names=["key"])

    keys = {r.key for r in spark.range(64).repartition(8).mapInArrow(held, "key string").collect()}
    assert not [k for k in keys if "quality" in k]


def test_every_document_has_its_decision(spark):
    found = QUERIES["op2_quality_classifier"](spark, "/root/testdata/sf0.01")
    all_, kept = found.count(), found.filter("keep").count()
    assert all_ == spark.read.parquet("/root/testdata/sf0.01/documents.parquet").count() and 0.8 * all_ < kept < all_
    assert found.filter("keep and perplexity > threshold and n_tokens > 1").count() == 0


def test_licences(spark):
    text = "Intro line of a text.\n" + licences.TEMPLATES["mit"] + "\nLicensed under the Apache License, Version 2.0!"
    df = spark.createDataFrame([(1, text), (2, None), (3, ""), (4, licences.TEMPLATES["isc"].upper()), (4, "x")], "doc_id long, text string")
    got = {tuple(r) for r in licences.licence_matches(df).select("doc_id", "line", "licence").collect()}
    assert {(1, 2, "mit"), (1, 3, "apache-2.0-line"), (4, 0, "isc"), (4, 1, "isc")} <= got
    assert not any(d in (2, 3) for d, _, _ in got) and licences.licence_matches(df.limit(0)).count() == 0


def test_licence_passages(spark):
    import re
    import textwrap

    notice = "(c) 2021 X. Released under the MIT License. All rights reserved."
    filler = "some other words of a document " * 40
    texts = {i: f"{filler}\n" + "\n".join(" * " + x for x in textwrap.wrap(t, 50, break_long_words=False)) + f"\n{filler}" for i, t in enumerate(licences.TEMPLATES.values())}
    texts |= {100: notice, 101: "no licence here", 102: f"{notice} {filler} {notice}"}
    df = spark.createDataFrame([*texts.items(), (103, None), (104, "")], "doc_id long, text string")
    got = {tuple(r) for r in licences.licence_passages(df).select("doc_id", "licence", "start", "words", "dice").collect()}
    for i, (name, t) in enumerate(licences.TEMPLATES.items()):
        size = len(re.sub("[^A-Za-z0-9]+", " ", t).split())
        assert (i, name, 241, size, 1.0) in got
    assert {r for r in got if r[0] in (100, 102)} == {
        (100, "mit-line", 4, 5, 1.0), (102, "mit-line", 4, 5, 1.0), (102, "mit-line", 255, 5, 1.0),
    }
    assert not any(r[0] in (101, 103, 104) for r in got) and licences.licence_passages(df.limit(0)).count() == 0


def test_licence_passages_against_all_runs(spark):
    random.seed(2)
    templates = {"t1": "a bb c a bb ddd", "t2": "the bb c ee under a c ee under the fff"}
    texts = [" ".join(random.choices(["a", "bb", "c", "ddd", "ee", "the", "under", "a bb c", "c ee under"], k=30)) for _ in range(60)]
    texts += [f"x {templates['t1']} {templates['t1']} y a bb c a {templates['t2'][:-8]} z"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")

    def bigrams(words):
        return list(zip(words, words[1:]))

    want = set()
    for i, text in enumerate(texts):
        grams = bigrams(text.split())
        for name, t in templates.items():
            asked = Counter(bigrams(t.split()))
            m, every = asked.total(), []
            for a in range(len(grams)):
                for b in range(a + 1, len(grams) + 1):
                    dice = round(2 * (Counter(grams[a:b]) & asked).total() / (b - a + m), 6)
                    if dice >= licences.LEAST:
                        every.append((-dice, a, b - a))
            held = []
            for run in sorted(every):
                if not any(run[1] <= x[1] + x[2] and x[1] <= run[1] + run[2] for x in held):
                    held.append(run)
            want |= {(i, a + 1, n + 1, name, -d) for d, a, n in held}
    got = {tuple(r) for r in licences.licence_passages(df, templates=templates).collect()}
    assert got == want and len(want) > 20


def test_token_counts_after_edits():
    files = token_counts.tokenizer_files()
    split = token_counts.splitter(files)
    random.seed(5)
    pieces = [" the", "  ", "\n", "'s", "don't", "12", "é", "!?", " x" * 9, "<|endoftext|>", "日本"]
    for start in ("", "a", " ".join("some words here" for _ in range(300))):
        counted = token_counts.CountedText.of(start, split)
        for _ in range(60):
            at, n = random.randint(0, len(counted.text) + 3), random.choice([0, 1, 5, 400])
            counted.edit(at, n, "".join(random.choices(pieces, k=random.choice([0, 1, 3, 200]))), split)
            assert counted.tokens == len(split.exact.encode(counted.text, add_special_tokens=False).ids)
            assert counted.chars[1] == len(counted.text)


def test_token_counts_odd_rows(odd):
    state = token_counts.build_state(odd, ["doc_id"])
    edits = F.array(F.struct(F.lit(-3).alias("start"), F.lit(None).cast("int").alias("length"), F.lit("new ").alias("replacement")))
    found = token_counts.apply_edits(state, edits)
    assert found.count() == len(ODD) and found.filter("text like 'new %'").count() == len(ODD)
    assert token_counts.apply_edits(state.limit(0), edits).count() == 0


def test_neighbours(spark):
    rng = np.random.default_rng(0)
    base = rng.standard_normal((400, 16))
    base[300:] = base[300]
    data = [(i, [float(x) for x in v]) for i, v in enumerate(base)]
    data += [(500, None), (550, [0.0] * 16), (600, [float("nan")] * 16), (None, data[0][1]), (7, data[7][1])]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>")
    found = neighbours.nearest(df, F.col("id") % 50 == 0).toPandas()
    unit = base / np.linalg.norm(base, axis=1, keepdims=True)
    hits = 0
    for q, group in found.groupby("query_id"):
        cos = unit @ unit[q]
        cos[q] = -2
        want = np.lexsort((np.arange(400), -np.round(cos, 12)))[:5]
        hits += len(set(want) & set(group["vec_id"]))
        assert group.sort_values("rank")["score"].is_monotonic_decreasing
    assert found["query_id"].nunique() == 8 and hits >= 0.9 * 40
    assert neighbours.nearest(df.limit(0), F.col("id") % 50 == 0).count() == 0


def test_nearest_on_the_given_vectors(spark):
    """Queries are the rows whose identifier 50 divides, candidates all rows."""
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    table = {r["vec_id"]: np.array(r["embedding"], float) for r in df.collect()}
    ids, unit = np.array(list(table)), np.array([v / np.linalg.norm(v) for v in table.values()])
    found = QUERIES["op7_rotated_codes_search"](spark, SF).toPandas()
    hits = n = 0
    for q in (i for i in table if i % 50 == 0):
        cos = np.where(ids == q, -2, unit @ unit[ids == q][0])
        want = ids[np.lexsort((ids, -np.round(cos, 12)))[:5]]
        hits += len(set(want) & set(found.loc[found["query_id"] == q, "vec_id"]))
        n += 5
    assert hits >= 0.9 * n and len(found) == n


@pytest.mark.parametrize("spread", [0.5, 100.0])
def test_nearest_over_cells(spark, monkeypatch, spread):
    """Clusters much smaller than cells, vectors without structure, and a vector that a
    third of all rows hold: many cells, and blocks of a few vectors and queries."""
    for name, value in {"CELL": 100, "HOME": 2, "CANDIDATES": 64, "QUERIES": 16, "PART": 8, "TRIALS": 32}.items():
        monkeypatch.setattr(neighbours, name, value)
    rng = np.random.default_rng(3)
    base = rng.standard_normal((200, 24))[rng.integers(0, 200, 3000)] + spread * rng.standard_normal((3000, 24))
    base[1000:2000] = base[1000]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(base)], "vec_id long, embedding array<double>")
    found = neighbours.nearest(df, F.col("id") % 50 == 0).toPandas()
    unit = base / np.linalg.norm(base, axis=1, keepdims=True)
    hits = 0
    for q, group in found.groupby("query_id"):
        cos = np.round(unit @ unit[q], 12)
        cos[q] = -2
        near = group.sort_values("rank")
        assert near["score"].tolist() == pytest.approx(unit[near["vec_id"]] @ unit[q], abs=1e-12)
        hits += len(set(np.lexsort((np.arange(3000), -cos))[:5]) & set(near["vec_id"]))
    assert found["query_id"].nunique() == 60 and len(found) == 300 and hits >= 0.9 * 300


def test_estimates_lie_within_their_bounds():
    rng = np.random.default_rng(5)
    vectors, queries, centres = rng.standard_normal((500, 40)), rng.standard_normal((20, 40)), neighbours.unit(rng.standard_normal((1, 40)))
    cell, words, *scalars = neighbours.encode(vectors, centres)
    assert words.shape == (500, 3) and not cell.any()
    cosine, width = neighbours.estimate(*neighbours.planes(queries), (neighbours.unit(queries) @ centres.T)[:, 0], words, *scalars)
    error = np.abs(cosine - neighbours.unit(queries) @ neighbours.unit(vectors).T)
    assert (error <= width).mean() > 0.98 and width.max() < 0.4


def test_nearest_with_equal_identifiers_and_extremes(spark):
    rows_ = [(0, [1.0, 0.0], 7), (1, [0.0, 1.0], 7), (1, [1.0, 0.1], 7), (1, [1.0, 0.1], 7), (2, [1e200, 1e199], 7), (3, [1e-200, 0.0], 7), (4, [5e-324, 0.0], 7),
             (50, [1.0, 1.0], 7), (50, [-1.0, 0.0], 7), (6, [1.0, 0.0, 0.0], 7)]
    df = spark.createDataFrame(rows_, "vec_id long, embedding array<double>, row long").withColumn("code", F.lit("x")).withColumn("size", F.lit(1))
    found = neighbours.nearest(df, F.col("id") % 50 == 0, k=8).toPandas()
    first = found[found["query_id"] == 0].sort_values("rank")
    assert first["vec_id"].tolist() == [3, 4, 1, 2, 50, 1, 50] and first["rank"].tolist() == [1, 2, 3, 4, 5, 6, 7]
    c = 1 / math.sqrt(1.01)
    assert first["score"].tolist() == pytest.approx([1, 1, c, c, math.sqrt(0.5), 0, -1], abs=1e-15)
    # both vectors of 50 ask, and each is a candidate of the other
    both = found[found["query_id"] == 50]
    assert len(both) == 14 and (both["vec_id"] == 50).sum() == 2


def test_bloom_scores(spark, docs, odd):
    marked = docs.withColumn("held_out", lm_bloom.held_out(F.col("doc_id")))
    sent, joined = (
        lm_bloom.score(marked, ~F.col("held_out"), ["doc_id", "held_out"], broadcast_mb=mb).toPandas().sort_values("doc_id", ignore_index=True) for mb in (512, 0)
    )
    texts = {r.doc_id: (r.text or "").encode().lower().split() + [None] for r in docs.collect()}
    counts = Counter(w for i, t in texts.items() if zlib.crc32(str(i).encode()) % 7 != 2 for w in t)
    n, v = sum(counts.values()), len(counts)
    for r in sent.itertuples():
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 7 == 2)
        assert (r.n_tokens, r.train_tokens) == (len(texts[r.doc_id]), n)
        assert r.base_score == pytest.approx(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in texts[r.doc_id]))
    assert joined["base_score"].tolist() == pytest.approx(sent["base_score"].tolist())
    # the filter's errors only raise counts
    assert (sent["score"].to_numpy() >= joined["score"].to_numpy() - 1e-6).all()
    assert abs((sent["score"] - joined["score"]) / sent["n_tokens"]).mean() < 0.01
    assert sent.loc[sent["held_out"], "score"].sum() > sent.loc[sent["held_out"], "base_score"].sum()
    assert lm_bloom.score(odd, F.lit(True), ["doc_id"]).count() == len(ODD)
    assert lm_bloom.score(odd.limit(0), F.lit(True), ["doc_id"]).count() == 0


def test_bloom_scores_do_not_depend_on_the_way_to_the_filter(spark, docs, odd):
    marked = docs.withColumn("held_out", lm_bloom.held_out(F.col("doc_id")))
    for df, training in ((marked, ~F.col("held_out")), (odd, F.lit(True)), (marked.limit(50), F.lit(False))):
        sent, shuffled = (
            lm_bloom.score(df, training, ["doc_id"], broadcast_mb=mb).toPandas().sort_values(["doc_id", "n_tokens"], ignore_index=True) for mb in (512, 0)
        )
        assert len(sent) == len(shuffled)
        for column in ("n_tokens", "n_known", "train_tokens", "base_score", "score"):
            assert shuffled[column].tolist() == pytest.approx(sent[column].tolist(), rel=1e-12)
    assert lm_bloom.score(odd.limit(0), F.lit(True), ["doc_id"], broadcast_mb=0).count() == 0


def test_urls(spark):
    pages = [(1, "https://u@News.Example.com:80/a/b?q#f", "2024-02-01"), (2, "http://example.com/", "2024-02-01"), (3, None, "2024-02-01"),
             (4, "", "2024-02-01"), (5, "http://news.example.com/a", "2023-01-01"), (5, "http://news.example.com/c", None)]
    entries = [("example.com", "2024-01-01", "block"), ("news.example.com", "2024-01-10", "allow"), ("news.example.com/a", "2024-01-20", "block"),
               ("news.example.com/a", "2024-02-02", "allow"), (None, "2024-01-01", "block"), ("example.com", "2024-01-01", "other")]
    p = spark.createDataFrame(pages, "page_id long, url string, day string").withColumn("day", F.col("day").cast("date"))
    e = spark.createDataFrame(entries, "key string, day string, action string").withColumn("day", F.col("day").cast("date"))
    found = Counter(rows(url_lists.filter_urls(p, e, ["page_id"]).select("page_id", "blocked", "matched_key")))
    want = [(1, True, "news.example.com/a"), (2, True, "example.com"), (3, False, None), (4, False, None), (5, False, None), (5, False, None)]
    assert found == Counter(want)
    assert url_lists.filter_urls(p, e.limit(0), ["page_id"]).filter("blocked").count() == 0
    assert url_lists.filter_urls(p.limit(0), e, ["page_id"]).count() == 0


def url_decisions(spark, pages, entries):
    p = spark.createDataFrame([(*r, "k", 1) for r in pages], "page_id long, url string, day string, key string, bin int")
    e = spark.createDataFrame([(*r, 0) for r in entries], "key string, day string, action string, at int")
    p, e = (t.withColumn("day", F.col("day").cast("date")) for t in (p, e))
    return Counter(rows(url_lists.filter_urls(p, e, ["page_id"]).select("page_id", "blocked", "matched_key")))


@pytest.mark.parametrize("key", ["Example.COM", "example.com/", "http://example.com", "https://me@EXAMPLE.com:8080/?q#f", "example.com.", " example.com "])
def test_forms_of_entry_keys(spark, key):
    pages = [(1, "http://www.example.com/x", "2024-02-01"), (2, "EXAMPLE.com.", "2024-02-01"), (3, "http://badexample.com/", "2024-02-01")]
    found = url_decisions(spark, pages, [(key, "2024-01-01", "block")])
    assert found == Counter([(1, True, "example.com"), (2, True, "example.com"), (3, False, None)])


def test_suffixes_paths_and_odd_captures(spark):
    entries = [("zip", "2024-01-01", "block"), ("a.zip//Docs/", "2024-01-01", "allow"), ("", "2024-01-01", "block"), ("http:///x", "2024-01-01", "block"),
               (None, "2024-01-01", "block"), ("open.org", "1999-01-01", "block"), ("late.org", "2030-01-01", "block")]
    long = "http://b.zip/" + "s/" * 20_000
    pages = [(1, "http://a.zip/Docs/x", "2024-02-01"), (2, "http://a.zip/docs/x", "2024-02-01"), (3, long, "2024-02-01"), (None, "zip", "2024-02-01"),
             (None, "zip", "2024-02-01"), (4, "http://open.org", "9999-12-31"), (5, "http://late.org", "2029-12-31"), (6, "http://", "2024-02-01"), (7, "http://open.org", None)]
    found = url_decisions(spark, pages[:2] + [(3, "http://b.zip/s/t", "2024-02-01")] + pages[3:], entries)
    want = [(1, False, "a.zip/Docs"), (2, True, "zip"), (3, True, "zip"), (None, True, "zip"), (None, True, "zip"), (4, True, "open.org"), (5, False, None), (6, False, None), (7, False, None)]
    assert found == Counter(want)
    short = long[:600]
    assert url_decisions(spark, [(3, short, "2024-02-01")], entries) == Counter([(3, True, "zip")])


def test_bins_only_where_captures_are(spark):
    bins = url_lists._bins_within([3, 4, 9, 50_000], F.col("a"), F.col("b"))
    df = spark.createDataFrame([(0, None), (4, 9), (5, 8), (10, 3)], "a long, b long")
    assert [r[0] for r in rows(df.select(bins))] == [[3, 4, 9, 50_000], [4, 9], [], []]
    assert [r[0] for r in rows(df.select(url_lists._bins_within([], F.col("a"), F.col("b"))))] == [[]] * 4


def test_pipeline(spark, docs):
    kept = docs
    for _, stage in corpus_pipeline.STAGES[:3]:
        before = {r.doc_id for r in kept.select("doc_id").collect()}
        kept = stage(spark, kept, SF)
        assert kept.columns == docs.columns and {r.doc_id for r in kept.select("doc_id").collect()} <= before
    near = simhash.near_duplicates(kept, ["doc_id"]).toPandas()
    assert near["component_id"].nunique() == len(near)
    packed = corpus_pipeline.run(spark, SF).toPandas()
    assert packed.groupby("sequence_id")["length"].sum().max() <= 1024


def test_sources_stay_off_the_driver(spark, monkeypatch):
    """As many as there are documents: their plan is that of the list, and no row of it is collected."""
    random.seed(6)
    sizes = {f"s{i}": random.choice([0, 1, 3, 20, random.randrange(2000)]) for i in range(1500)}
    docs = [(i, " ".join(["w"] * n), s) for i, (s, n) in enumerate(sizes.items())] + [(-1, "a b c", None)]
    docs = spark.createDataFrame(docs, "doc_id long, text string, source string")
    taken = []
    frame = type(docs)
    monkeypatch.setattr(frame, "collect", lambda self, f=frame.collect: (taken.append(f(self)), taken[-1])[1])
    found = mixing.mix(docs, [1, 2, 3]).toArrow().to_pylist()
    mixed = mixing.mixed_documents(docs, [1, 2, 3]).toArrow().num_rows
    assert max(map(len, taken)) <= 3 and mixed > 500
    names = [*sorted(sizes), None]
    all_ = [sizes.get(s, 3) for s in names]
    want = dict(zip(names, mixing.targets(all_, [1 + i % 3 for i in range(len(names))])))
    source = dict(zip([*range(len(sizes)), -1], [*sizes, None]))
    assert len(found) == len(names) and {r["doc_id"]: r["target"] for r in found} == {i: want[s] for i, s in source.items()}
    assert sum(want.values()) == pytest.approx(sum(all_))


@pytest.mark.parametrize("broadcast_mb", [64, 0], ids=["sent", "segments"])
def test_every_trusted_word_counts(spark, broadcast_mb):
    """Rare words too, as themselves: against dictionaries of all words."""
    random.seed(12)
    # no word follows itself
    texts = [" ".join(f"the {random.choice(['old', f'w{random.randrange(400)}', f'{i}'])}" for _ in range(random.choice([2, 10]))) for i in range(300)]
    copies = Counter(texts)
    df = spark.createDataFrame([(i, t, copies[t]) for i, t in enumerate(texts)] + [(900, "the w1000 old", None)], "doc_id long, text string, copies long")
    trusted = df.filter("copies is not null")
    found = quality.with_perplexity(df.repartition(2), ["doc_id", "text"], trusted, broadcast_mb=broadcast_mb).collect()
    log10 = _kneser_ney(texts, quality.train(trusted)["steps"], lambda t: quality.hashed(t.split()))
    assert len(found) == 301
    for r in found:
        assert math.isclose(r.perplexity, 10 ** (-log10(r.text) / r.n_tokens), rel_tol=1e-9), r.text
