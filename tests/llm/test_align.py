"""Tokenizer alignment against brute force."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from scrubline.llm import align
from scrubline.llm.align import Pair, tokenizer_files

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def pair():
    return Pair(**tokenizer_files())


def groups_of(text, pair):
    """``[(A ids, B ids)]`` by walking both token lists."""
    want = (" " + (text or "")).encode()
    if not text:
        return []
    a = pair.exact.encode(" " + text, add_special_tokens=False).ids
    b = pair.model.encode(text)
    if b"".join(pair.a_bytes[i] for i in a) != want or b"".join(pair.b_bytes[i] for i in b) != want:
        return []
    out, i, j = [], 0, 0
    while i < len(a):
        left, right = [a[i]], [b[j]]
        x, y = len(pair.a_bytes[a[i]]), len(pair.b_bytes[b[j]])
        while x != y:
            if x < y:
                i += 1
                left.append(a[i])
                x += len(pair.a_bytes[a[i]])
            else:
                j += 1
                right.append(b[j])
                y += len(pair.b_bytes[b[j]])
        out.append((left, right))
        i, j = i + 1, j + 1
    return out


def brute(docs, pair):
    groups = [groups_of(t, pair) for _, t in docs]
    linked = [[(x, y) for a, b in g for x in a for y in b] for g in groups]
    count = Counter(p for doc in linked for p in set(doc))
    best = defaultdict(int)
    for (x, _), n in count.items():
        best[x] = max(best[x], n)
    rows = []
    for (ident, _), g, ps in zip(docs, groups, linked):
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in g)
        sums = sum(count[p] == best[p[0]] for p in ps), sum(count[p] for p in ps)
        rows.append((ident, sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), len(ps), text, *sums))
    return sorted(rows, key=str), count


ODD = [(1, None), (2, ""), (3, " "), (4, "a  b\n\nc "), (4, "a  b\n\nc "), (5, "▁x"), (6, "<s> hi </s><unk><|endoftext|>"), (None, "<0x41>\x00"),
       (7, "naïve café — 東京タワー 🙂🙂 "), (8, "ab" * 3000 + " " * 700 + "x\t\r\n"), (9, "the " * 20_000), (10, "the the thee"), (11, "é ﬁ Ω")]
COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups", "n_best", "count_sum"]


def ours(spark, docs, **how):
    df = spark.createDataFrame([(*d, 1, "x", "y") for d in docs], "doc_id long, text string, chunk long, row string, pairs string")
    return sorted([tuple(r) for r in align.alignment(df, ["doc_id"], **how).select(COLUMNS).collect()], key=str)


def test_odd_rows(spark, pair):
    want, _ = brute(ODD, pair)
    assert ours(spark, ODD) == want
    assert (1, 0, 0, 0, 0, "", 0, 0) in want
    assert ours(spark, []) == [] and ours(spark, ODD[:2]) == brute(ODD[:2], pair)[0]


def test_pieces_of_text_in_many_chunks(spark, pair, monkeypatch):
    monkeypatch.setattr(align, "CHUNK_BYTES", 300)
    monkeypatch.setattr(align, "SEGMENT_PAIRS", 50)
    monkeypatch.setattr(align, "LINKS_AT_ONCE", 12)
    random.seed(1)
    signs = ["the", "ing", "é", "Z", "1234", "  ", "\n", "q", "東", "🙂", "­", "ation", "'s"]
    docs = [(i, "".join(random.choices(signs, k=random.randrange(60)))) for i in range(150)]
    want, count = brute(docs, pair)
    assert ours(spark, docs) == want
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    aligned = align.aligned_texts(df, ["doc_id"])
    totals, segments = align.irregular_totals(aligned)
    assert segments > 3
    found = {(r.a, r.b): r.n for r in align.pair_counts(aligned, totals).collect()}
    assert found == dict(count)


def test_invalid_bytes(spark):
    df = spark.sql("select 1L as doc_id, cast(x'61ff62' as string) as text")
    assert align.alignment(df, ["doc_id"]).select("n_a", "groups").first() == (0, "")


def test_identity_map(pair):
    for a, b in enumerate(pair.same):
        if b >= 0:
            assert pair.a_bytes[a] == pair.b_bytes[b]
    assert (pair.same >= 0).sum() > 10_000 and len(set(pair.a_bytes)) == len(pair.a_bytes)


def test_long_groups_have_all_links():
    a, b = np.array([1, 2, 1, 5], np.uint64), np.array([3, 3, 4], np.uint64)
    stops = np.array([3, 4]), np.array([2, 3])
    want = {(0, 1, 3): 4, (0, 2, 3): 2, (0, 5, 4): 1}
    for limit in (1, 100):
        align.LINKS_AT_ONCE, kept = limit, align.LINKS_AT_ONCE
        try:
            keys, n = align.links(a, b, *stops, np.array([0, 0]))
        finally:
            align.LINKS_AT_ONCE = kept
        assert {(int(k) >> 32, int(k) >> 16 & 0xFFFF, int(k) & 0xFFFF): int(x) for k, x in zip(keys, n)} == want


def test_registered_query(spark, pair):
    from scrubline.llm.queries import QUERIES

    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    want = [(*r[:5], hashlib.sha256(r[5].encode()).hexdigest() if r[5] else "", *r[6:]) for r in brute(docs, pair)[0]]
    got = QUERIES["op12_tokenizer_alignment"](spark, SF)
    names = ["groups_sha256" if c == "groups" else c for c in COLUMNS]
    assert sorted(got.columns) == sorted(names)
    assert sorted(tuple(r) for r in got.select(names).collect()) == sorted(want)
