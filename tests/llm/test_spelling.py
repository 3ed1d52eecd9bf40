"""Spelling variants against brute force."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from scrubline.llm import spelling

SF = "/root/testdata/sf0.001"
RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def counted(docs, letters=5, least=3):
    found = Counter()
    for ident, text in docs:
        for run in RUN.findall(text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if ident is None else ident}:{run}".encode())
            if h % 97 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            if len(run) >= letters:
                found[run] += 1
    return {w: n for w, n in found.items() if n >= least}


def neighbours(words):
    """Near words by patterns with one place left out."""
    holes, near = defaultdict(list), defaultdict(set)
    for w in words:
        for i in range(len(w)):
            holes[w[:i], w[i + 1 :]].append(w)
            if (short := w[:i] + w[i + 1 :]) in words:
                near[w].add(short)
                near[short].add(w)
    for group in holes.values():
        for x in group:
            near[x].update(y for y in group if y != x)
    return near


def brute(words, ratio=2):
    near, form = neighbours(words), {}
    for w, n in words.items():
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        if best and words[best] >= ratio * n:
            form[w] = best
    rows = []
    for w, n in words.items():
        root = w
        while root in form:
            root = form[root]
        rows.append((w, form.get(w), root, n, len(near[w]), words.get(form.get(w))))
    return sorted(rows, key=str)


def ours(df):
    return sorted([tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect()], key=str)


def random_words(seed, size=400, letters="abé"):
    random.seed(seed)
    words = {"".join(random.choices(letters, k=random.randrange(5, 9))) for _ in range(size)}
    return {w: random.choice([3, 4, 6, 7, 12, 13, 24, 50, 200]) for w in words}


@pytest.mark.parametrize("groups", [None, 2, 5])
def test_brute_force(spark, groups, monkeypatch):
    monkeypatch.setattr(spelling, "BLOCK", 64)
    monkeypatch.setattr(spelling, "SUBTREE", 40)
    monkeypatch.setattr(spelling, "BUCKET_ROWS", 500)
    for letters in ("abé", "abcdefghÀßÿ×"):
        words = random_words(len(letters), letters=letters)
        df = spark.createDataFrame(list(words.items()), "word string, n long")
        assert ours(spelling.variants(df, groups=groups)) == brute(words)


def test_one_letter_apart():
    random.seed(2)
    x = ["".join(random.choices("ab", k=random.randrange(1, 7))) for _ in range(3000)]
    y = [random.choice([w[1:] + "ab", w + "a", "b" + w, w[:2] + "a" + w[2:], w[:-1] + "b", w]) for w in x]
    kept = [(a, b) for a, b in zip(x, y) if 0 <= len(b) - len(a) <= 1]
    want = [b in neighbours({a, b})[a] for a, b in kept]
    words = [w.encode() for pair in kept for w in pair]
    at, size = np.arange(len(kept)) * 2, np.array([len(w) for w in words])
    assert spelling.one_letter_apart(words, size, at, at + 1).tolist() == want and 0 < sum(want) < len(want)


def test_trie_finds_what_counts_allow():
    random.seed(4)
    words = sorted({"".join(random.choices("abcé", k=random.randrange(1, 6))).encode("latin-1") for _ in range(300)})
    counts = np.column_stack([np.zeros(len(words), np.int64), spelling.letter_counts(words)])
    deficit = np.arange(len(words)) % 2 == 0
    found = Counter()
    for q, row in spelling.Trie(counts).search(counts, deficit):
        found.update(zip(q.tolist(), row.tolist()))
    change = counts[None, :, 1:] - counts[:, None, 1:]
    near = (np.maximum(change, 0).sum(2) <= 1) & (np.maximum(-change, 0).sum(2) <= deficit[:, None])
    assert set(found) == set(zip(*(x.tolist() for x in np.nonzero(near)))) and set(found.values()) == {1}


LONG = "a" * 20_000
ODD = [(1, None), (2, ""), (3, "12 — ?"), (None, "Apple apple APPLE appel"), (4, "apples apples apples, Äpfel Äpfel äpfel"), (4, "apples apples apples, Äpfel Äpfel äpfel"),
       (5, f"{LONG} {LONG} {LONG} {LONG}b {LONG}b {LONG}b"), (6, "Ωapple apple2 東apple"), (7, "äpfel " * 30_000)]


def test_odd_rows(spark):
    df = spark.createDataFrame([(*r, "w", 1, "f") for r in ODD], "doc_id long, text string, word string, n long, form string")
    words = counted(ODD)
    counts = spelling.word_counts(df, modulus=97)
    assert dict((r.word, r.n) for r in counts.collect()) == words
    assert ours(spelling.variants(counts)) == brute(words)
    assert ours(spelling.variants(spelling.word_counts(df.limit(0), modulus=97))) == []


def test_chains_end_at_their_roots(spark):
    chain = {"aaaaa" + "b" * i: 3 * 2**i for i in range(14)}
    df = spark.createDataFrame(list(chain.items()), "word string, n long")
    assert ours(spelling.variants(df)) == brute(chain)
    assert {r.root for r in spelling.variants(df).collect()} == {"aaaaa" + "b" * 13}


def test_registered_query(spark):
    from scrubline.llm.queries import QUERIES

    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    want = brute(counted(docs))
    assert ours(QUERIES["op13_spelling_variants"](spark, SF)) == want and any(r[1] for r in want)
