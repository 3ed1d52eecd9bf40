"""Token counts that follow edits.

A document's state is its text and two segment trees over leaves of about ``LEAF``
pre-tokens: characters and tokens, each as one array in heap order.  An edit replaces
a range of characters.  Descending the character tree finds the leaves it touches.
Splitting into pre-tokens goes from left to right and looks at most a few characters
ahead, so it can start again at a leaf's start a little before the edit, and as soon as
it meets an old leaf's start beyond the edit, the rest is as before.  Only that region
is encoded again; its leaves and the sums above them are updated.  A region that has
outgrown its leaves gets more of them, and the sums are made anew without encoding.

The strings of special tokens count as ordinary text.

Defined cases: a null text is empty and has no tokens; an edit's start and length are
cut to the text (negative or null: zero), a null replacement is empty; without edits
(null) nothing changes; documents without identifier and repeated rows are documents of
their own; an empty table gives an empty result; further columns do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import worker_value
from .packing import UNUSUAL, load, tokenizer_files

LEAF, AHEAD, WORDS_HELD = 32, 4, 1 << 19
EDITS = "array<struct<start:int,length:int,replacement:string>>"


class Splitter:
    """Pre-tokens of a text and their token counts; counts of words are remembered."""

    def __init__(self, vocabulary: str, ranks: str | None, pattern: str):
        import regex

        self.find = regex.compile(pattern)
        self.exact, self.fast = load(vocabulary, ranks, pattern)
        self.exact.encode_special_tokens = True
        self.known: dict[str, int] = {}

    def count(self, part: str) -> int:
        if self.fast is None or UNUSUAL.search(part):
            return len(self.exact.encode(part, add_special_tokens=False).ids)
        return len(self.fast.encode_ordinary(part))

    def counts(self, parts: list[str]) -> list[int]:
        known = self.known
        if len(known) > WORDS_HELD:
            known.clear()
        known.update((p, self.count(p)) for p in set(parts).difference(known))
        return [known[p] for p in parts]

    def split(self, text: str) -> list[str]:
        return self.find.findall(text)


def splitter(tokenizer: dict) -> Splitter:
    return worker_value(("splitter", tokenizer["vocabulary"]), lambda: Splitter(**tokenizer))


def heap(leaves: np.ndarray) -> np.ndarray:
    """A sum tree: node i has the children 2i and 2i + 1, the leaves are the second half."""
    size = 1 << max(0, int(len(leaves) - 1).bit_length())
    tree = np.zeros(2 * size, np.int64)
    tree[size : size + len(leaves)] = leaves
    while size > 1:
        tree[size // 2 : size] = tree[size : 2 * size : 2] + tree[size + 1 : 2 * size : 2]
        size //= 2
    return tree


def grouped(parts: list[str], counts: list[int], groups: int) -> tuple[np.ndarray, np.ndarray]:
    """Characters and tokens of ``groups`` leaves that share the pre-tokens evenly."""
    bounds = np.arange(groups) * len(parts) // groups
    ends = np.append(bounds[1:], len(parts))
    sums = [np.append(0, np.cumsum(x)) if len(x) else np.zeros(1, np.int64) for x in (list(map(len, parts)), counts)]
    return sums[0][ends] - sums[0][bounds], sums[1][ends] - sums[1][bounds]


class CountedText:
    """A text with its trees; ``tokens`` is the sum at the root."""

    def __init__(self, text: str, chars: np.ndarray, tokens: np.ndarray):
        self.text, self.chars, self.tokens_tree, self.encoded = text, chars, tokens, 0

    @classmethod
    def of(cls, text: str, split: Splitter) -> CountedText:
        parts = split.split(text)
        chars, tokens = grouped(parts, split.counts(parts), max(1, -(-len(parts) // LEAF)))
        return cls(text, heap(chars), heap(tokens))

    @property
    def tokens(self) -> int:
        return int(self.tokens_tree[1])

    def leaf_at(self, place: int) -> tuple[int, int]:
        """The leaf that holds the character ``place``, and where it starts."""
        node, start, size = 1, 0, len(self.chars) // 2
        while node < size:
            node *= 2
            if place - start >= self.chars[node] and self.chars[node + 1]:
                start += int(self.chars[node])
                node += 1
        return node - size, start

    def edit(self, start: int, length: int, replacement: str, split: Splitter) -> None:
        size = len(self.chars) // 2
        start = min(max(0, start), len(self.text))
        end = min(start + max(0, length), len(self.text))
        first, low = self.leaf_at(max(0, start - AHEAD))
        last, last_start = self.leaf_at(end)
        high = last_start + int(self.chars[size + last])
        self.text = self.text[:start] + replacement + self.text[end:]
        shift = len(replacement) - (end - start)
        parts, at = [], low
        for match in split.find.finditer(self.text, low):
            while high + shift < at and last + 1 < size:
                last += 1
                high += int(self.chars[size + last])
            if at == high + shift and at >= start + len(replacement):
                break
            parts.append(match.group())
            at = match.end()
        else:
            last = size - 1  # split to the end of the text
        counts = split.counts(parts)
        self.encoded += sum(map(len, parts))
        leaves = last - first + 1
        if len(parts) > 2 * LEAF * leaves:
            chars, tokens = grouped(parts, counts, -(-len(parts) // LEAF))
            after = size + last + 1
            used = len(np.trim_zeros(self.chars[after:], "b"))
            self.chars, self.tokens_tree = (
                heap(np.concatenate([tree[size : size + first], new, tree[after : after + used]]))
                for tree, new in ((self.chars, chars), (self.tokens_tree, tokens))
            )
            return
        for tree, new in zip((self.chars, self.tokens_tree), grouped(parts, counts, leaves)):
            tree[size + first : size + last + 1] = new
            a, b = (size + first) // 2, (size + last) // 2
            while a:
                tree[a : b + 1] = tree[2 * a : 2 * b + 2 : 2] + tree[2 * a + 1 : 2 * b + 2 : 2]
                a, b = a // 2, b // 2


STATE = "text string, chars array<bigint>, tokens array<bigint>"


def _rows(batch: pa.RecordBatch, states: list[CountedText], extra: list) -> pa.RecordBatch:
    lists = [pa.array([t.tolist() for t in tree], pa.list_(pa.int64())) for tree in ([s.chars for s in states], [s.tokens_tree for s in states])]
    columns = [batch.column("row"), pa.array([s.text for s in states], pa.string()), *lists, *extra]
    names = ["row", "text", "chars", "tokens", "n_tokens", "encoded_chars"]
    return pa.RecordBatch.from_arrays(columns, names=names[: len(columns)])


def build_state(docs: DataFrame, kept: list[str], text_col: str = "text", tokenizer: dict | None = None) -> DataFrame:
    """``row`` (the columns ``kept``), ``text``, ``chars`` and ``tokens``: the trees of every document."""
    tokenizer = tokenizer or tokenizer_files()
    rows = docs.select(F.struct(*kept).alias("row"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = splitter(tokenizer)
        for batch in batches:
            for low in range(0, batch.num_rows, 512):
                part = batch.slice(low, 512)
                states = [CountedText.of(t.as_py() or "", split) for t in part.column("text")]
                yield _rows(part, states, [])

    return rows.mapInArrow(run, f"row {rows.schema['row'].dataType.simpleString()}, {STATE}")


def apply_edits(state: DataFrame, edits: Column, tokenizer: dict | None = None) -> DataFrame:
    """The state after the edits of each row, one after another, and ``n_tokens`` and
    ``encoded_chars``, the characters that were encoded again.  ``edits`` is an array of
    (start, length, replacement) in characters."""
    tokenizer = tokenizer or tokenizer_files()
    rows = state.select("row", "text", "chars", "tokens", edits.cast(EDITS).alias("edits"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = splitter(tokenizer)
        for batch in batches:
            for low in range(0, batch.num_rows, 512):
                part = batch.slice(low, 512)
                states = []
                for text, chars, tokens, changes in zip(*(part.column(c) for c in ("text", "chars", "tokens", "edits"))):
                    trees = [t.values.to_numpy(zero_copy_only=False).copy() for t in (chars, tokens)]
                    states.append(CountedText(text.as_py() or "", *trees))
                    for e in changes.as_py() or []:
                        states[-1].edit(e["start"] or 0, e["length"] or 0, e["replacement"] or "", split)
                counts = [pa.array([s.tokens for s in states], pa.int64()), pa.array([s.encoded for s in states], pa.int64())]
                yield _rows(part, states, counts)

    schema = f"row {rows.schema['row'].dataType.simpleString()}, {STATE}, n_tokens bigint, encoded_chars bigint"
    return rows.mapInArrow(run, schema)
