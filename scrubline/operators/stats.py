"""Column statistics: modes, mean, quantiles, distributions."""

from __future__ import annotations

import math
from bisect import bisect_left
from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce
from itertools import accumulate
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scrubline.functions.missing import NAN, Missing, count_where, is_missing, named


def value_distribution(df: DataFrame, column: str) -> DataFrame:
    """(value, n), most frequent first, ties by value."""
    return (
        df.groupBy(named(column).alias("value"))
        .agg(F.count("*").alias("n"))
        .orderBy(F.desc("n"), F.asc("value"))
    )


def _slot_type(dtype: T.DataType) -> T.DataType:
    return T.StringType() if isinstance(dtype, (T.CharType, T.VarcharType)) else dtype


def modes_row(df: DataFrame, rules: Mapping[str, Missing]) -> DataFrame:
    """One row with a struct (value, n) per column: its most frequent value.

    One shuffle counts the values of all columns together: the rows are
    unpivoted to (column number, value) with one slot per data type, so that
    values are equal as their own type has it (zeros of either sign, instants),
    and counted before they leave their task, so a value held by a third of the
    rows is one row per task.  The counts then meet in an aggregate without
    keys, one row per task again.  A tie goes to the smallest value, a column
    without values gives NULL.
    """
    names = list(rules)
    types = {c: _slot_type(df.schema[c].dataType) for c in names}
    slots = {t: f"value{i}" for i, t in enumerate(dict.fromkeys(types.values()))}

    def unpivoted(i: int, name: str) -> list[Column]:
        value = F.when(~is_missing(df, name, rules[name]), named(name))
        return [F.lit(i)] + [
            (value if t == types[name] else F.lit(None)).cast(t) for t in slots
        ]

    pairs = [part for i, c in enumerate(names) for part in unpivoted(i, c)]
    counts = (
        df.select(F.stack(F.lit(len(names)), *pairs).alias("which", *slots.values()))
        .where(reduce(or_, (F.col(v).isNotNull() for v in slots.values())))
        .groupBy("which", *slots.values())
        .agg(F.count("*").alias("n"))
    )

    def best(i: int, name: str) -> Column:
        rank = F.struct((-F.col("n")).alias("down"), F.col(slots[types[name]]).alias("value"))
        return F.min(F.when(F.col("which") == i, rank)).alias(name)

    def shown(name: str) -> Column:
        value, n = named(name).getField("value"), -named(name).getField("down")
        mode = F.struct(value.alias("value"), n.alias("n"))
        return F.when(named(name).isNotNull(), mode).alias(name)

    row = counts.agg(*(best(i, c) for i, c in enumerate(names)))
    return row.select(*(shown(c) for c in names))


def column_modes(df: DataFrame, rules: Mapping[str, Missing]) -> DataFrame:
    """(column, mode as text, n), one row per column in ``rules``."""
    as_text = "struct<value:string,n:bigint>"
    wide = modes_row(df, rules).select(
        F.lit(1).alias("__one"), *(named(c).cast(as_text).alias(c) for c in rules)
    )
    return wide.unpivot("__one", list(rules), "column", "best").select(
        "column", F.col("best.value").alias("mode"), F.col("best.n").alias("n")
    )


def column_mean(df: DataFrame, column: str) -> DataFrame:
    """One row, ``mean``: the average without NULL and NaN."""
    present = F.when(~is_missing(df, column, NAN), named(column).try_cast("double"))
    return df.agg(F.avg(present).alias("mean"))


# Steps of the shares that a sketch is asked for, and groups of tasks with a sketch each.
STEPS, GROUPS = 1000, 256


@dataclass(frozen=True)
class Look:
    """What one pass says about a column.

    ``rows`` with a number, ``points`` (value, rank up to it) in order, where a
    rank is right within two of ``steps``, and the counts asked for on the way.
    """

    rows: int
    points: tuple[tuple[float, float], ...]
    steps: int
    counts: dict[str, int]

    def element(self, rank: float) -> float:
        """The first point whose rank reaches ``rank``, or the last one."""
        at = bisect_left(self.points, rank, key=lambda point: point[1])
        return self.points[min(at, len(self.points) - 1)][0]


def _number(column: str) -> Column:
    """The column as double; NULL for NaN and for text that is no number."""
    value = named(column).try_cast("double")
    return F.when(~F.isnan(value), value)


def _look(
    df: DataFrame, value: Column, counts: Mapping[str, Column] | None = None, steps: int = STEPS
) -> Look:
    """One scan and one shuffle of a row per task.

    Merging the sketches of all tasks would be the work of one.  So ``GROUPS``
    tasks merge those of a part of the tasks each, and hand ``steps`` quantiles
    with the number of rows to the driver, which puts them in one order: its
    share is bounded whatever the table.
    """
    counts = counts or {}
    shares = [i / steps for i in range(steps + 1)]
    groups = (
        df.groupBy((F.spark_partition_id() % GROUPS).alias("__group"))
        .agg(
            F.count(value).alias("__rows"),
            F.percentile_approx(value, shares, steps).alias("__points"),
            *(c.alias(f"__n{i}") for i, c in enumerate(counts.values())),
        )
        .collect()
    )
    weighted = sorted(
        (point, g["__rows"] / steps if i else 0.0)
        for g in groups
        for i, point in enumerate(g["__points"] or ())
    )
    ranks = accumulate(weight for _, weight in weighted)
    return Look(
        sum(g["__rows"] for g in groups),
        tuple(zip((point for point, _ in weighted), ranks)),
        steps,
        {name: sum(g[f"__n{i}"] for g in groups) for i, name in enumerate(counts)},
    )


def look_at(df: DataFrame, column: str, counts: Mapping[str, Column] | None = None) -> Look:
    """A :class:`Look` at ``column``, with aggregates that count, in the same pass."""
    return _look(df, _number(column), counts)


def approximate_quantile(
    df: DataFrame, column: str, q: float = 0.5, relative_error: float = 0.01
) -> float | None:
    """An element of the column whose rank is within ``relative_error`` of ``q``.

    One pass; a sketch of about ``4 / relative_error`` entries in a task.  NULL
    and NaN are skipped; a column without values gives None.
    """
    look = _look(df, _number(column), steps=math.ceil(4 / relative_error))
    return look.element(q * look.rows) if look.rows else None


def exact_quantile(
    df: DataFrame,
    column: str,
    q: float = 0.5,
    small: int = 100_000,
    look: Look | None = None,
    steps: int = STEPS,
) -> float | None:
    """The smallest element whose cumulative share reaches ``q``, exactly.

    Keeping every distinct value in one task, as the exact percentile
    aggregates do, does not scale.  Instead a bounded sketch proposes two
    bracketing elements, and one counting pass says whether the wanted rank
    falls on either of them, between them or outside; the search goes on in
    that open interval, which holds a few thousandths of the rows, and which the
    same pass has sketched if it is expected to be large.  A heavy value is hit
    as a bracket end rather than carried along.  Only an interval of at most
    ``small`` rows comes to the driver.  The result does not depend on the
    quality of the sketch, only the number of passes does.

    ``look`` saves the first pass if :func:`look_at` ran on the column before.
    """
    v = F.col("v")
    part = df.select(_number(column).alias("v")).where(v.isNotNull())
    look = look or _look(part, v, steps=steps)
    rank = max(1, math.ceil(q * look.rows))
    while look.rows > small:
        reach = 2 * look.rows / look.steps
        left, right = look.element(rank - reach), look.element(rank + reach)
        inside = (v > left) & (v < right)
        counts = {
            "before": count_where(v < left),
            "left": count_where(v == left),
            "between": count_where(inside),
            "right": count_where((v == right) & (v > left)),
        }
        if 3 * reach > small:
            inner = _look(part, F.when(inside, v), counts, steps)
            n = inner.counts
        else:
            inner = None
            n = part.agg(*(c.alias(a) for a, c in counts.items())).first().asDict()
        if rank <= n["before"]:
            part = part.where(v < left)
            look = _look(part, v, steps=steps)
            continue
        rank -= n["before"]
        if rank <= n["left"]:
            return left
        rank -= n["left"]
        if rank <= n["between"]:
            part = part.where(inside)
            if n["between"] <= small:
                break
            look = inner or _look(part, v, steps=steps)
            continue
        rank -= n["between"]
        if rank <= n["right"]:
            return right
        rank -= n["right"]
        part = part.where(v > right)
        look = _look(part, v, steps=steps)
    if not look.rows:
        return None
    return sorted(r.v for r in part.collect())[rank - 1]
