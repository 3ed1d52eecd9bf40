"""Exact modes that do not shuffle the values of a nearly unique column.

:func:`~scrubline.operators.stats.modes_row` moves every different value of a task.  For
a column such as a name that is most of the table.  Here frequent-item sketches, one for
each of a bounded number of groups of tasks, only propose values.  A counting pass then
counts the proposed values exactly and all others by hash bucket: no other value can be
more frequent than its bucket.  If the best proposed value beats every bucket, it is the
mode, whatever the quality of the sketches; what moved is a few thousand counts a task.

Where the proof fails, the values are about equally rare.  Then 8-byte hashes are counted instead of
values.  If no hash occurs twice, every value is a mode and the smallest one is taken by
a plain minimum; if not, only the values of the most frequent hashes are counted.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scrubline.functions.missing import Missing, is_missing, named
from scrubline.operators.stats import GROUPS, modes_row

TRACKED, PROPOSED, BUCKETS, LONGEST = 1024, 16, 1024, 256
SKETCHED = (T.NumericType, T.StringType, T.DateType, T.TimestampType, T.TimestampNTZType)


@dataclass(frozen=True)
class Mode:
    """A most frequent value, how often it occurs and what proved it."""

    value: object
    n: int
    proof: str


def _present(df: DataFrame, rules: Mapping[str, Missing]) -> dict[str, Column]:
    return {c: F.when(~is_missing(df, c, r), named(c)) for c, r in rules.items()}


def _proposed(df: DataFrame, values: Mapping[str, Column]) -> dict[str, list]:
    """At most ``PROPOSED`` values of each column, none of them long.

    One row of values for each group of tasks comes to the driver.
    """

    def short(name: str) -> Column:
        if isinstance(df.schema[name].dataType, T.StringType):
            return F.when(F.length(values[name]) <= LONGEST, values[name])
        return values[name]

    def sketch(i: int, name: str) -> Column:
        # the name of the call is only in SQL
        return F.call_function("approx_top_k", short(name), F.lit(PROPOSED + 1), F.lit(TRACKED)).alias(f"__{i}")

    groups = (
        df.groupBy((F.spark_partition_id() % GROUPS).alias("__group"))
        .agg(*(sketch(i, c) for i, c in enumerate(values)))
        .collect()
    )
    found = {}
    for i, name in enumerate(values):
        counts: Counter = Counter()
        for group in groups:
            counts.update({e["item"]: e["count"] for e in group[f"__{i}"] if e["item"] is not None and e["item"] == e["item"]})
        found[name] = [value for value, _ in counts.most_common(PROPOSED)]
    return found


def _stacked(df: DataFrame, parts: Mapping[str, list[Column]], names: list[str]) -> DataFrame:
    cells = [x for i, p in enumerate(parts.values()) for x in (F.lit(i), *p)]
    return df.select(F.stack(F.lit(len(parts)), *cells).alias("which", *names))


def _proven(df: DataFrame, values: Mapping[str, Column], proposed: Mapping[str, list]) -> dict[str, Mode]:
    """The columns whose best proposed value beats every bucket of the others."""
    types = {c: df.schema[c].dataType for c in values}
    slots = {t: f"value{i}" for i, t in enumerate(dict.fromkeys(types.values()))}

    def cells(name: str) -> list[Column]:
        value, kind = values[name], types[name]
        literals = [F.lit(v).cast(kind) for v in proposed[name]]
        chosen = F.coalesce(value.isin(*literals), F.lit(False)) if literals else F.lit(False)
        bucket = F.when(value.isNotNull() & ~chosen, F.pmod(F.xxhash64(value), F.lit(BUCKETS)))
        own = F.when(chosen, value)
        return [(own if t == kind else F.lit(None)).cast(t) for t in slots] + [bucket.cast("int")]

    rows = _stacked(df, {c: cells(c) for c in values}, [*slots.values(), "bucket"])
    counts = (
        rows.where(reduce(or_, (F.col(c).isNotNull() for c in (*slots.values(), "bucket"))))
        .groupBy("which", *slots.values(), "bucket")
        .agg(F.count("*").alias("n"))
    )

    def best(i: int, name: str) -> Column:
        own = (F.col("which") == i) & F.col("bucket").isNull()
        return F.min(F.when(own, F.struct((-F.col("n")).alias("down"), F.col(slots[types[name]]).alias("value"))))

    def others(i: int) -> Column:
        return F.max(F.when((F.col("which") == i) & F.col("bucket").isNotNull(), F.col("n")))

    row = counts.agg(
        *(best(i, c).alias(f"best{i}") for i, c in enumerate(values)),
        *(others(i).alias(f"others{i}") for i in range(len(values))),
    ).first()
    found = {}
    for i, name in enumerate(values):
        top, rest = row[f"best{i}"], row[f"others{i}"] or 0
        if top and -top["down"] > rest:
            found[name] = Mode(top["value"], -top["down"], "counted")
        elif not top and not rest:
            found[name] = None
    return found


def _hashed(df: DataFrame, values: Mapping[str, Column]) -> dict[str, Mode]:
    """Modes by counts of hashes, for columns that have values."""
    rows = _stacked(df, {c: [F.when(v.isNotNull(), F.xxhash64(v))] for c, v in values.items()}, ["h"])
    counts = rows.where("h is not null").groupBy("which", "h").agg(F.count("*").alias("n"))
    most = counts.agg(*(F.max(F.when(F.col("which") == i, F.col("n"))) for i in range(len(values)))).first()
    found = {}
    unique = [c for i, c in enumerate(values) if most[i] == 1]
    if unique:
        least = df.agg(*(F.min(values[c]) for c in unique)).first()
        found = {c: Mode(least[i], 1, "unique") for i, c in enumerate(unique)}
    for i, (name, value) in enumerate(values.items()):
        if name in found:
            continue
        top = counts.where((F.col("which") == i) & (F.col("n") == most[i])).select("h")
        column = df.select(value.alias("value")).where("value is not null")
        tied = column.join(top, F.xxhash64("value") == F.col("h"), "left_semi")
        best = F.min(F.struct((-F.col("n")).alias("down"), F.col("value")))
        row = tied.groupBy("value").agg(F.count("*").alias("n")).agg(best.alias("best")).first()["best"]
        if -row["down"] == most[i]:
            found[name] = Mode(row["value"], most[i], "hashed")
    return found


def bounded_modes(df: DataFrame, rules: Mapping[str, Missing]) -> dict[str, Mode | None]:
    """The mode of every column in ``rules``, ties to the smallest value; None without values.

    Two passes for columns with a frequent value; one or two more for those without.
    """
    sketched = {c: r for c, r in rules.items() if isinstance(df.schema[c].dataType, SKETCHED)}
    found: dict[str, Mode | None] = {}
    if sketched:
        values = _present(df, sketched)
        found = _proven(df, values, _proposed(df, values))
        left = {c: v for c, v in values.items() if c not in found}
        if left:
            found |= _hashed(df, left)
    # other types, and values whose hashes collide
    rest = {c: r for c, r in rules.items() if c not in found}
    if rest:
        row = modes_row(df, rest).first()
        found |= {c: Mode(row[c]["value"], row[c]["n"], "shuffled") if row[c] else None for c in rest}
    return {c: found[c] for c in rules}


def bounded_modes_table(df: DataFrame, rules: Mapping[str, Missing]) -> DataFrame:
    """(column, mode as text, n), as :func:`~scrubline.operators.stats.column_modes` has it."""
    found = bounded_modes(df, rules)

    def row(name: str, mode: Mode | None) -> Column:
        text = F.lit(mode and mode.value).cast(df.schema[name].dataType).cast("string")
        n = F.lit(mode and mode.n).cast("bigint")
        return F.struct(F.lit(name).alias("column"), text.alias("mode"), n.alias("n"))

    return df.sparkSession.range(1).select(F.inline(F.array(*(row(c, m) for c, m in found.items()))))
