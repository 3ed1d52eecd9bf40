"""Exact quantiles of many columns in the same passes.

Each pass answers all columns together.  The first makes a KLL sketch of every column;
sketches are small and mergeable, so tasks are merged in bounded groups and the groups in
one row.  A sketch's rank error brackets the wanted element between two of the column's
values.  The second pass counts what lies before the bracket and the values within it,
which is a few thousandths of the rows at most, added up by value before they leave their task.
The counts prove that the wanted rank is inside; if a sketch was wrong, or too much is left
inside, its column goes on with a narrower or wider bracket while the others are done.
The result does not depend on the sketches, only the number of passes does.
"""

from __future__ import annotations

import math
from collections.abc import Iterable
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from scrubline.functions.missing import count_where, named
from scrubline.operators.stats import GROUPS

# Size of a sketch, and a bound of its rank error that fails about once in a hundred.
SIZE, ERROR, STEPS = 2048, 0.0016, 2000
SMALL = 200_000
INFINITY = float("inf")


@dataclass(frozen=True)
class Bracket:
    """What is known of one column's wanted element: ``low <= element <= high``."""

    low: float = -INFINITY
    high: float = INFINITY
    rank: int = 0
    reach: float = 2 * ERROR


def _number(column: str) -> Column:
    value = named(column).try_cast("double")
    return F.when(~F.isnan(value), value)


def _inside(value: Column, at: Bracket) -> Column:
    """NULL outside the bracket; without a bound there is nothing to test."""
    if at.low == -INFINITY and at.high == INFINITY:
        return value
    return F.when((value >= at.low) & (value <= at.high), value)


def _sketches(df: DataFrame, values: list[Column], brackets: list[Bracket]) -> Row:
    """One row: for each column the rows before and inside its bracket, and ``STEPS``
    evenly spaced quantiles there."""
    parts = []
    for i, (value, at) in enumerate(zip(values, brackets)):
        inside = _inside(value, at)
        parts += [
            count_where(value < at.low).alias(f"b{i}"),
            F.count(inside).alias(f"n{i}"),
            F.kll_sketch_agg_double(inside, SIZE).alias(f"s{i}"),
        ]
    groups = df.groupBy((F.spark_partition_id() % GROUPS).alias("__group")).agg(*parts)
    # an empty sketch has no quantiles
    held = [F.when(F.col(f"n{i}") > 0, F.col(f"s{i}")) for i in range(len(values))]
    merged = groups.agg(
        *(F.sum(f"{x}{i}").alias(f"{x}{i}") for i in range(len(values)) for x in "bn"),
        *(F.kll_merge_agg_double(s, SIZE).alias(f"s{i}") for i, s in enumerate(held)),
    )
    shares = F.array(*(F.lit(k / STEPS) for k in range(STEPS + 1)))
    points = [
        F.when(F.col(f"n{i}") > 0, F.kll_sketch_get_quantile_double(F.col(f"s{i}"), shares)).alias(f"p{i}")
        for i in range(len(values))
    ]
    return merged.select(*(f"{x}{i}" for i in range(len(values)) for x in "bn"), *points).first()


def _narrowed(at: Bracket, before: int, n: int, points: list[float], q: float) -> Bracket:
    """The bracket that the sketch's quantiles give for the wanted rank."""
    rank = at.rank or max(1, math.ceil(q * n))
    share, slack = (rank - before) / n, at.reach + 1 / n
    low = max(0, math.floor((share - slack) * STEPS))
    high = min(STEPS, math.ceil((share + slack) * STEPS))
    return replace(at, low=points[min(low, STEPS)], high=points[max(high, 0)], rank=rank)


def exact_quantiles(df: DataFrame, columns: Iterable[str], q: float = 0.5, small: int = SMALL) -> dict[str, float | None]:
    """For each column the smallest element whose cumulative share reaches ``q``.

    NULL, NaN and text that is no number are skipped; None for a column without values.
    Two passes for tables of up to some 20 million rows, one more for each further factor
    of a hundred.
    """
    found: dict[str, float | None] = {}
    state = {c: Bracket() for c in dict.fromkeys(columns)}
    while state:
        names = list(state)
        row = _sketches(df, [_number(c) for c in names], [state[c] for c in names])
        narrow: dict[str, Bracket] = {}
        for i, c in enumerate(names):
            at, before, n = state[c], row[f"b{i}"], row[f"n{i}"]
            if not n and not at.rank:
                found[c] = None
                del state[c]
            elif not n or at.rank and not before < at.rank <= before + n:
                state[c] = Bracket(rank=at.rank, reach=4 * at.reach)  # a wrong sketch
            else:
                closer = _narrowed(at, before, n, row[f"p{i}"], q)
                state[c] = replace(at, rank=closer.rank)
                many = 2 * (at.reach + 1 / STEPS) * n + 2 > small
                if many and at.low < closer.low < closer.high < at.high:
                    state[c] = closer  # look again, within
                else:
                    narrow[c] = closer
        for c, rows in _counted(df, narrow, 4 * small).items():
            value = _element(rows, narrow[c].rank)
            if value is None:
                state[c] = Bracket(rank=state[c].rank, reach=4 * state[c].reach)
            else:
                found[c] = value
                del state[c]
    return {c: found[c] for c in dict.fromkeys(columns)}


def _counted(df: DataFrame, brackets: dict[str, Bracket], most: int) -> dict[str, list[tuple[float | None, int]]]:
    """For each column (value, rows) of the values in its bracket, NULL for all before it."""
    if not brackets:
        return {}
    cells = []
    for i, (c, at) in enumerate(brackets.items()):
        value = _number(c)
        cells += [F.lit(i), value <= at.high, F.when(value >= at.low, value)]
    stacked = df.select(F.stack(F.lit(len(brackets)), *cells).alias("which", "upto", "value"))
    counts = stacked.where("upto").groupBy("which", "value").agg(F.count("*").alias("n"))
    rows = counts.limit(most + 1).collect()
    found: dict[str, list] = {c: [] for c in brackets}
    if len(rows) > most:
        return found
    names = list(brackets)
    for r in rows:
        found[names[r["which"]]].append((r["value"], r["n"]))
    return found


def _element(rows: list[tuple[float | None, int]], rank: int) -> float | None:
    """The value that holds ``rank``; None if the bracket does not."""
    before = sum(n for value, n in rows if value is None)
    if rank <= before:
        return None
    for value, n in sorted(r for r in rows if r[0] is not None):
        before += n
        if rank <= before:
            return value
    return None


def quantile_table(df: DataFrame, columns: Iterable[str], q: float = 0.5, small: int = SMALL) -> DataFrame:
    """(column, value), one row per column."""
    found = exact_quantiles(df, columns, q, small)
    rows = F.array(*(F.struct(F.lit(c).alias("column"), F.lit(v).cast("double").alias("value")) for c, v in found.items()))
    return df.sparkSession.range(1).select(F.inline(rows))
