"""Near duplicates by SimHash: fingerprints that differ in few bits are linked.

Fingerprints: every bit is the majority of that bit over the hashes of all word
shingles, repeats included.  Links are searched among distinct fingerprints, so
copies of one text cost nothing.

Search: a fingerprint is mapped to the bit counts of its 32 two-bit segments.
The Manhattan distance of two such vectors is a lower bound of their bit
distance.  The counts are kept in unary form (0, 1, 2 as 00, 01, 11), where the
Manhattan distance is the number of differing bits.  The grid: the segments fall
into ``groups`` groups; two vectors within distance d agree in all but d groups,
so they share the grid cell of at least one choice of ``groups - d`` groups.  In
each cell the Manhattan bound is tested first, then the bits themselves.  The
number of groups grows with the number of fingerprints, which keeps cells small.

A cell never gives all its pairs: a task reduces what it links to a forest.  A
cell larger than ``CELL`` is dealt out as pairs of blocks, so that no task gets
more than two blocks of a cell at once.

Defined cases: a text that is null or has no words has fingerprint zero and is
linked like any other; fewer words than a shingle make one shingle; a null
identifier is ignored when the smallest of a component is taken (null if there
is no other); rows that are repeated keep their rows; an empty table gives an
empty result; further columns do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stage
from .components import components

BITS, SEGMENTS, SEED = 64, 32, 42
CELL = 4096
CHUNK = 1 << 16
# chance that a two-bit segment of two unrelated fingerprints has equal counts
EQUAL = 0.375


def fingerprint(text: bytes | None, shingle: int = 4) -> int:
    """The 64-bit fingerprint of a UTF-8 text."""
    tokens = (text or b"").lower().split()
    if not tokens:
        return 0
    line = b" ".join(tokens)
    lengths = np.fromiter(map(len, tokens), np.int64, len(tokens))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    size = min(shingle, len(tokens))
    n = len(tokens) - size + 1
    hashed = xxhash.xxh64_intdigest
    ones = np.zeros(BITS, np.int64)
    for low in range(0, n, CHUNK):
        high = min(n, low + CHUNK)
        spans = zip(starts[low:high].tolist(), ends[low + size - 1 : high + size - 1].tolist())
        values = np.fromiter((hashed(line[a:b], SEED) for a, b in spans), np.uint64, high - low)
        bits = np.unpackbits(values.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int32)
    return int(np.packbits(ones * 2 > n, bitorder="little").view(np.uint64)[0])


def with_fingerprint(docs: DataFrame, kept: list[str], text_col: str = "text", shingle: int = 4) -> DataFrame:
    """The columns ``kept`` of ``docs`` and ``fp``, the fingerprint as a signed long."""
    rows = docs.select(F.struct(*kept).alias("row"), F.col(text_col).cast("binary").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.fromiter(
                (fingerprint(t.as_py(), shingle) for t in batch.column("text")), np.uint64, batch.num_rows
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(values.view(np.int64))], names=["row", "fp"]
            )

    row_type = rows.schema["row"].dataType.simpleString()
    return rows.mapInArrow(run, f"row {row_type}, fp bigint").select("row.*", "fp")


def unary_counts(fp: Column) -> Column:
    """The counts of the two-bit segments, each in unary form."""
    low = fp.bitwiseOR(F.shiftrightunsigned(fp, 1)).bitwiseAND(F.lit(0x5555555555555555))
    high = fp.bitwiseAND(F.shiftleft(fp, 1)).bitwiseAND(F.lit(-0x5555555555555556))
    return low.bitwiseOR(high)


def group_masks(groups: int) -> list[int]:
    """One mask of whole segments per group."""
    bounds = [2 * (SEGMENTS * g // groups) for g in range(groups + 1)]
    return [(1 << high) - (1 << low) for low, high in zip(bounds, bounds[1:])]


def groups_for(n: int, distance: int) -> int:
    """The fewest groups with at most about 1,000 unrelated candidates per fingerprint."""
    for groups in range(distance + 2, min(SEGMENTS, distance + 8)):
        fixed = SEGMENTS * (groups - distance) / groups
        if comb(groups, distance) * n * EQUAL**fixed <= 1000:
            return groups
    return min(SEGMENTS, distance + 8)


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _grid(points: DataFrame, distance: int, groups: int) -> DataFrame:
    """A row per fingerprint and choice of groups: the cell it lies in."""
    masks = group_masks(groups)
    cells = [
        F.struct(F.lit(i).alias("choice"), F.col("u").bitwiseAND(F.lit(_signed(sum(masks[g] for g in choice)))).alias("cell"))
        for i, choice in enumerate(combinations(range(groups), groups - distance))
    ]
    return points.select("fp", "u", F.explode(F.array(*cells)).alias("at")).select("at.*", "fp", "u")


def _settle(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Join the trees of a[i] and b[i]; every label is the root of its tree."""
    while True:
        low, high = np.minimum(label[a], label[b]), np.maximum(label[a], label[b])
        apart = low != high
        if not apart.any():
            return label
        a, b = a[apart], b[apart]
        np.minimum.at(label, high[apart], low[apart])
        while not np.array_equal(up := label[label], label):
            label = up


def _forest(start: np.ndarray, fp: np.ndarray, u: np.ndarray, distance: int) -> np.ndarray:
    """Labels of the rows: linked rows of a group share one. ``start`` marks first rows."""
    n = len(fp)
    first = np.flatnonzero(start)
    ends = np.repeat(np.append(first[1:], n), np.diff(np.append(first, n)))
    label, active = np.arange(n), np.arange(n)
    waiting: list[tuple[np.ndarray, np.ndarray]] = []
    held, step = 0, 1
    while len(active := active[active + step < ends[active]]):
        other = active + step
        near = np.bitwise_count(u[active] ^ u[other]) <= distance
        a, b = active[near], other[near]
        near = (np.bitwise_count(fp[a] ^ fp[b]) <= distance) & (label[a] != label[b])
        if near.any():
            waiting.append((a[near], b[near]))
            held += int(near.sum())
        if held > 1 << 20:
            label, waiting, held = _settle(label, *map(np.concatenate, zip(*waiting))), [], 0
        step += 1
    return _settle(label, *map(np.concatenate, zip(*waiting))) if waiting else label


def _link(distance: int):
    """A function of batches sorted by group: a forest of the links in each group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("choice", "cell", "pair", "fp", "u")
        rest = [np.zeros(0, np.int64)] * 5
        last = False
        stream = iter(batches)
        while not last:
            batch = next(stream, None)
            last = batch is None
            if not last:
                new = [batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in names]
                rest = [np.concatenate(x) for x in zip(rest, new)]
            n = len(rest[0])
            if not n:
                continue
            start = np.ones(n, bool)
            start[1:] = np.any([x[1:] != x[:-1] for x in rest[:3]], axis=0)
            whole = n if last else int(np.flatnonzero(start)[-1])  # the last group may go on
            fp, u = (x[:whole].view(np.uint64) for x in rest[3:])
            if whole:
                label = _forest(start[:whole], fp, u, distance)
                linked = np.flatnonzero(label != np.arange(whole))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(fp[linked].view(np.int64)), pa.array(fp[label[linked]].view(np.int64))], names=["a", "b"]
                )
            rest = [x[whole:] for x in rest]

    return run


def fingerprint_links(points: DataFrame, distance: int = 4) -> DataFrame:
    """Pairs ``(a, b)`` that connect just the fingerprints within ``distance``
    bits of each other.  ``points``: distinct ``fp``, best a written table."""
    points = points.select("fp", unary_counts(F.col("fp")).alias("u"))
    grid = _grid(points, distance, groups_for(points.count(), distance))
    large = stage(
        grid.groupBy("choice", "cell").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > CELL), "cells"
    )
    blocks = F.ceil(F.col("n") / CELL)
    mine = F.pmod(F.xxhash64("fp"), blocks)
    pairs = F.when(F.col("n").isNull(), F.array(F.lit(0).cast("long"))).otherwise(
        F.transform(F.sequence(F.lit(0).cast("long"), blocks - 1), lambda j: F.least(mine, j) * blocks + F.greatest(mine, j))
    )
    dealt = (
        grid.join(large, ["choice", "cell"], "left")
        .select("choice", "cell", F.explode(pairs).alias("pair"), "fp", "u")
        .repartition("choice", "cell", "pair")
        .sortWithinPartitions("choice", "cell", "pair")
    )
    return dealt.mapInArrow(_link(distance), "a bigint, b bigint")


def near_duplicates(
    docs: DataFrame, kept: list[str], id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, distance: int = 4
) -> DataFrame:
    """The columns ``kept`` of every document, ``fp``, ``component_id``, the smallest
    identifier that can be reached over links, and ``root``, the fingerprint that
    tells its component apart."""
    prints = stage(with_fingerprint(docs, kept, text_col, shingle), "fingerprints")
    rows = prints.count()
    points = stage(prints.groupBy("fp").agg(F.min(id_col).alias("least_id")), "points", at_most=rows)
    nearest = components(fingerprint_links(points, distance))
    root = points.join(nearest, points["fp"] == nearest["u"], "left").select(
        "fp", "least_id", F.coalesce("v", "fp").alias("root")
    )
    least = root.groupBy("root").agg(F.min("least_id").alias("component_id"))
    classes = stage(root.join(least, "root").select("fp", "component_id", "root"), "classes", at_most=rows)
    return prints.join(classes, "fp").select(*kept, "fp", "component_id", "root")


def keep_one_of_each(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, distance: int = 4
) -> DataFrame:
    """``docs`` with one document of each group of near duplicates: the one with
    the smallest identifier, and one row of it if rows repeat."""
    rows = stage(docs.select(F.struct("*").alias("row"), F.monotonically_increasing_id().alias("at")), "documents")
    slim = rows.select(F.col(f"row.`{id_col}`").alias("id"), F.col(f"row.`{text_col}`").alias("text"), "at")
    found = near_duplicates(slim, ["id", "at"], "id", "text", shingle, distance)
    best = found.groupBy("root").agg(F.min(F.struct(F.col("id").isNull(), "id", "at")).alias("best"))
    return rows.join(best.select(F.col("best.at").alias("at")), "at", "left_semi").select("row.*")
