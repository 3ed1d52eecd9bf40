"""Spelling variants of a corpus's words by a trie of letter-group counts.

Words are maximal runs of A-Z, a-z and U+00C0 to U+00FF, with A-Z lower-cased.  Two words
are near if one inserted, deleted or replaced letter makes one of the other; then the
counts of their letter groups differ by at most one more in one group (surplus) and at
most one less in another (deficit).

The trie arranges words by successive letter-group counts.  Its first ``groups`` levels
are broad groups that share out the whole alphabet, so they also fix a word's length.
Spark deals the trie out by them: a word is a member of its own subtree, and goes as a
query to every subtree that spends at most one surplus and one deficit on the broad
levels.  Of two subtrees that could ask each other only one does.  ``groups`` is the
least number for which no subtree has more than ``SUBTREE`` members (all letters end it).

A task holds some subtrees as one trie: below a subtree every letter of a-z is a level of
its own, the others share a few.  Blocks of queries go down it depth first; a state is a
query, a node and what is left of the budget, and a block that grows too large is cut in
two and put back on the stack.  A node with a single word is compared with the query's
remaining counts at once.  The words of reached leaves are verified letter by letter.

A word's form is its near word with the most occurrences (then the first in code-point
order), if these are at least ``ratio`` times its own.  Along forms the occurrences at least
double, so doubling the steps finds every root in a few rounds of joins.

Bounds: a word has at most some hundred near words a letter, a task the subtrees of one
bucket.  Nothing is collected but numbers of rows, and nothing is broadcast.

Defined cases: null, empty and letterless texts have no words; a null identifier counts as
the empty text when letters are deleted; repeated rows count as often as they occur; an
empty table gives an empty result; further columns do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import lower_ascii, stage, text_or_empty

LETTERS = "A-Za-zÀ-ÿ"
SUBTREE, BUCKET_ROWS, BLOCK = 20_000, 50_000, 1 << 15
# A-z from common to rare, which makes upper levels of the trie split well.
BY_FREQUENCY = "etaoinsrhldcumfpgwybvkxjqz"
OTHERS = "".join(map(chr, range(0xC0, 0x100)))
LEVELS, MOST = 32, 60


def letter_runs(text: Column) -> Column:
    return F.split(text_or_empty(text), f"[^{LETTERS}]+")


def shortened(word: Column, ident: Column, modulus: int) -> Column:
    """``word`` without one letter if ``modulus`` divides the CRC-32 of ``ident:word``."""
    h = F.crc32(F.concat(F.coalesce(ident.cast("string"), F.lit("")), F.lit(":"), word).cast("binary"))
    at = F.pmod(h, F.char_length(word)).cast("int")
    cut = F.concat(F.substring(word, F.lit(1), at), F.substring(word, at + 2, F.char_length(word)))
    return F.when(h % modulus == 0, cut).otherwise(word)


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", modulus: int | None = None, letters: int = 5, least: int = 3) -> DataFrame:
    """``word`` and ``n``: words of at least ``letters`` letters that occur ``least`` times
    or more.  ``modulus`` deletes letters as ``shortened`` says."""
    runs = docs.select(F.col(id_col).alias("id"), F.explode(letter_runs(F.col(text_col))).alias("run"))
    # no run gets longer
    words = runs.filter(F.char_length("run") >= letters).select("id", lower_ascii(F.col("run")).alias("word"))
    if modulus:
        words = words.select(shortened(F.col("word"), F.col("id"), modulus).alias("word"))
        words = words.filter(F.char_length("word") >= letters)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least)


def broad_counts(word: Column, groups: int) -> list[Column]:
    """How many letters of each of ``groups`` broad groups a word has."""
    alphabet = BY_FREQUENCY + OTHERS
    return [F.char_length(word) - F.char_length(F.translate(word, alphabet[g::groups], "")) for g in range(groups)]


def number_of_groups(words: DataFrame) -> int:
    """The least number of broad groups that leaves no subtree above ``SUBTREE`` words."""
    groups = 2
    while groups < LEVELS:
        sizes = words.groupBy(*broad_counts(F.col("word"), groups)).count()
        if (sizes.agg(F.max("count")).first()[0] or 0) <= SUBTREE:
            break
        groups += 1
    return groups


def routes(words: DataFrame, groups: int) -> DataFrame:
    """``subtree``, ``word``, ``n`` and ``role``: 0 a member, 1 a query of the same length,
    2 a query with one letter less."""
    count = [F.col("c")[g] for g in range(groups)]

    def route(role: int, more: int | None = None, less: int | None = None) -> Column:
        changed = [c + int(g == more) - int(g == less) for g, c in enumerate(count)]
        found = F.struct(F.concat_ws(",", *[c.cast("string") for c in changed]).alias("subtree"), F.lit(role).alias("role"))
        return found if less is None else F.when(count[less] > 0, found)

    asked = [route(0), *[route(2, g) for g in range(groups)]]
    asked += [route(1, g, h) for g in range(groups) for h in range(g + 1, groups)]
    counted = words.select("word", "n", F.array(*broad_counts(F.col("word"), groups)).alias("c"))
    sent = counted.select("word", "n", F.explode(F.array(*asked)).alias("r"))
    return sent.filter("r is not null").select("r.subtree", "r.role", "word", "n")


def letter_counts(words: list[bytes]) -> np.ndarray:
    """The counts of the letters of a-z and of classes of the others, a row a word."""
    level = np.zeros(256, np.int64)
    for i, letter in enumerate(BY_FREQUENCY):
        level[ord(letter)] = i
    rest = LEVELS - len(BY_FREQUENCY)
    for i, letter in enumerate(OTHERS):
        level[ord(letter)] = len(BY_FREQUENCY) + i % rest
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    letters = np.frombuffer(b"".join(words), np.uint8)
    place = np.repeat(np.arange(len(words)), sizes) * LEVELS + level[letters]
    return np.bincount(place, minlength=len(words) * LEVELS).reshape(-1, LEVELS).astype(np.int32)


class Trie:
    """A trie over rows of counts.  Nodes of a level are numbered in order; ``first`` and
    ``size`` say which of the sorted rows are below a node."""

    def __init__(self, counts: np.ndarray):
        self.order = np.lexsort(counts.T[::-1])
        self.counts = counts[self.order]
        self.small = np.minimum(self.counts[:, 1:], MOST).astype(np.int8)
        self.base = int(self.counts.max(initial=0)) + 2
        node = np.zeros(len(counts), np.int64)
        self.children, self.first, self.size = [], [], []
        for level in range(counts.shape[1]):
            keys, first, node, size = np.unique(
                node * self.base + self.counts[:, level], return_index=True, return_inverse=True, return_counts=True
            )
            self.children.append(keys)
            self.first.append(first)
            self.size.append(size)

    def child(self, level: int, node: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether each node has a child with ``count``, and which."""
        keys, wanted = self.children[level], node * self.base + count
        at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        return (keys[at] == wanted) & (count >= 0) & (count < self.base), at

    def search(self, queries: np.ndarray, deficit: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """``(query, row)`` wherever a row has at most one letter more, and at most
        ``deficit`` less, than the query; the first column has to agree."""
        last = self.counts.shape[1] - 1
        small = np.minimum(queries[:, 1:], MOST).astype(np.int8)
        starts = range(0, len(queries), BLOCK) if len(self.counts) else []
        stack = []
        for low in starts:
            q = np.arange(low, min(low + BLOCK, len(queries)))
            stack.append((0, q, np.zeros(len(q), np.int64), np.ones(len(q), bool), deficit[q]))
        while stack:
            level, q, node, surplus, less = stack.pop()
            if len(q) > 2 * BLOCK:
                half = len(q) // 2
                stack += [(level, *(x[part] for x in (q, node, surplus, less))) for part in (slice(half, None), slice(None, half))]
                continue
            c = queries[q, level]
            found = []
            for step, allowed in ((0, None), (1, surplus), (-1, less)):
                if level == 0 and step:
                    continue
                at = np.arange(len(q)) if allowed is None else np.flatnonzero(allowed)
                has, child = self.child(level, node[at], c[at] + step)
                at, child = at[has], child[has]
                found.append((q[at], child, surplus[at] & (step != 1), less[at] & (step != -1)))
            q, node, surplus, less = (np.concatenate(x) for x in zip(*found))
            size = self.size[level][node]
            done = (size == 1) | (level == last)
            if done.any():
                yield from self._rows(small, q[done], self.first[level][node[done]], size[done], deficit)
            if not done.all():
                stack.append((level + 1, *(x[~done] for x in (q, node, surplus, less))))

    def _rows(
        self, queries: np.ndarray, q: np.ndarray, first: np.ndarray, size: np.ndarray, deficit: np.ndarray
    ) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The rows below nodes that were reached, by all their counts.  Counts above
        ``MOST`` are taken for equal, as the words themselves are compared later."""
        q = np.repeat(q, size)
        row = np.repeat(first, size) + np.arange(len(q)) - np.repeat(np.cumsum(size) - size, size)
        for low in range(0, len(q), BLOCK):
            some, rows = q[low : low + BLOCK], row[low : low + BLOCK]
            change = self.small[rows] - queries[some]
            more, less = (change > 0) * change, (change < 0) * change
            near = (more.sum(1, dtype=np.int16) <= 1) & (less.sum(1, dtype=np.int16) >= -deficit[some].astype(np.int16))
            yield some[near], self.order[rows[near]]


def one_letter_apart(words: list[bytes], size: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Whether each word ``y`` is the word ``x`` with one letter replaced or inserted.
    ``y`` has as many letters or one more."""
    found = np.zeros(len(x), bool)
    order = np.argsort(size[y], kind="stable")
    sorted_size = size[y[order]]
    low = 0
    while low < len(order):
        # words of one length share a block
        n = int(sorted_size[low])
        high = min(int(np.searchsorted(sorted_size, n, side="right")), low + max(1, BLOCK * 32 // n))
        at = order[low:high]
        a, b = (np.array([words[i] for i in side[at]], f"S{n}").view(np.uint8).reshape(-1, n) for side in (x, y))
        length = size[x[at]]
        differs = a != b
        start = np.where(differs.any(1), differs.argmax(1), n)
        # an inserted letter shifts what follows it
        shifted = np.zeros_like(differs)
        shifted[:, 1:] = a[:, : n - 1] != b[:, 1:]
        end = np.where(shifted.any(1), n - 1 - shifted[:, ::-1].argmax(1), 0)
        found[at] = np.where(length == n, differs.sum(1) == 1, end <= start)
        low = high
    return found


def near_in_bucket(subtree: np.ndarray, role: np.ndarray, words: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places ``(query, member)`` of near words, each pair once."""
    _, number = np.unique(subtree, return_inverse=True)
    counts = np.column_stack([number.astype(np.int32), letter_counts(words)])
    size = np.fromiter(map(len, words), np.int64, len(words))
    member = np.flatnonzero(role == 0)
    trie = Trie(counts[member])
    for q, row in trie.search(counts, role < 2):
        m = member[row]
        twice = (role[q] == 0) & (q >= m)
        q, m = q[~twice], m[~twice]
        good = one_letter_apart(words, size, q, m)
        yield q[good], m[good]


def near_words(words: DataFrame, groups: int | None = None) -> DataFrame:
    """``word``, ``n``, ``other`` and ``m`` of every pair of near words, each pair once.
    ``words`` (a written table) has ``word`` and ``n``, every word once."""
    groups = groups or number_of_groups(words)
    asked = routes(words, groups)
    size = words.count() * (1 + groups + groups * (groups - 1) // 2)
    bucket = F.pmod(F.xxhash64("subtree"), F.lit(size // BUCKET_ROWS + 1)).alias("bucket")

    def search(rows: pa.Table) -> pa.Table:
        subtree = rows["subtree"].to_numpy()
        word = [w.encode("latin-1") for w in rows["word"].to_pylist()]
        pairs = list(near_in_bucket(subtree, rows["role"].to_numpy(), word))
        q, m = (np.concatenate([np.zeros(0, np.int64), *x]) for x in zip(*pairs)) if pairs else np.zeros((2, 0), np.int64)
        left, right = rows.select(["word", "n"]).take(pa.array(q)), rows.select(["word", "n"]).take(pa.array(m))
        return pa.table([*left.columns, *right.columns], names=["word", "n", "other", "m"])

    return asked.select(bucket, "*").groupBy("bucket").applyInArrow(search, "word string, n long, other string, m long")


def roots(forms: DataFrame) -> DataFrame:
    """``word`` and ``root``, the end of its chain of forms, for rows with ``word`` and ``form``."""
    now = stage(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        joined = now.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved"))
        after = stage(joined, "roots")
        now = after.select("word", "root")
        if after.filter("moved").isEmpty():
            return now


def variants(words: DataFrame, ratio: float = 2, groups: int | None = None) -> DataFrame:
    """``word``, ``n``, ``n_near``, ``form``, ``form_n`` and ``root`` of every word of
    ``words`` (``word`` of Latin-1 letters, ``n``)."""
    words = stage(words.select("word", "n"), "words")
    pairs = stage(near_words(words, groups), "near")
    both = pairs.select("word", "other", "m").union(pairs.select(F.col("other").alias("word"), F.col("word").alias("other"), F.col("n").alias("m")))
    best = F.min(F.struct((-F.col("m")).alias("m"), F.col("other").alias("form"))).alias("best")
    near = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best)
    fits = -F.col("best.m") >= ratio * F.col("n")
    joined = words.join(near, "word", "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(fits, F.col("best.form")).alias("form"),
        F.when(fits, -F.col("best.m")).alias("form_n"),
    )
    formed = stage(joined, "forms")
    ends = roots(formed.filter("form is not null"))
    return formed.join(ends, "word", "left").withColumn("root", F.coalesce("root", "word"))
