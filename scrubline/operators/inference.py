"""Types of text columns, told without losing a value.

An inferred type must give every text back: the version ``1.10`` is no number, as 1.1 is
another text, nor is the code ``007``.  All columns are tested in one aggregate: for each type a column
could have, it counts the texts that the type cannot hold or would show differently.  The
first type of the lattice that loses none is the column's type; text is always one.

    boolean < (nothing)     bigint < decimal < double     date, timestamp
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scrubline.functions.missing import EMPTY, Missing, count_where, is_missing, named
from scrubline.operators.observed import count_table

# The texts of plain numbers.  No sign but a minus, no leading zero before
# another digit, no minus zero.
WHOLE = r"^(?:0|-?[1-9][0-9]*)\z"
FRACTION = r"^-?(?:0|[1-9][0-9]*)\.[0-9]+\z"
SHORT_FRACTION = r"^-?(?:0|[1-9][0-9]*)\.(?:0|[0-9]*[1-9])\z"
DATE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}\z"
TIME = r"^[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2}\z"
# Digits that a double always gives back, and that a decimal can have.
DOUBLE_DIGITS, DECIMAL_DIGITS = 15, 38


def _digits(text: Column) -> Column:
    return F.length(F.regexp_replace(text, "[^0-9]", ""))


def _significant(text: Column) -> Column:
    return F.length(F.regexp_replace(F.regexp_replace(text, "[^0-9]", ""), "^0+", ""))


def _scale(text: Column) -> Column:
    places = F.length(F.substring_index(text, ".", -1))
    return F.when(F.contains(text, F.lit(".")), places).when(text.isNotNull(), 0)


def _holds(text: Column) -> dict[str, Column]:
    """For each type, whether it gives the text back."""
    whole, fraction = text.rlike(WHOLE), text.rlike(FRACTION)
    date = F.when(text.rlike(DATE), text.try_cast("date").cast("string"))
    time = F.when(text.rlike(TIME), text.try_cast("timestamp_ntz").cast("string"))
    return {
        "boolean": text.isin("true", "false"),
        "int": whole & (text.try_cast("int").cast("string") == text),
        "bigint": whole & (text.try_cast("bigint").cast("string") == text),
        # a column has one scale, which is tested over the column
        "decimal": (whole | fraction) & (_digits(text) <= DECIMAL_DIGITS),
        "double": text.rlike(SHORT_FRACTION) & (_significant(text) <= DOUBLE_DIGITS),
        "date": date == text,
        "timestamp": time == text,
    }


def _parts(i: int, present: Column) -> list[Column]:
    lost = {t: ~F.coalesce(ok, F.lit(False)) for t, ok in _holds(present).items()}
    return [
        F.count(present).alias(f"n{i}"),
        *(count_where(present.isNotNull() & bad).alias(f"{t}{i}") for t, bad in lost.items()),
        F.min(_scale(present)).alias(f"least{i}"),
        F.max(_scale(present)).alias(f"most{i}"),
        F.max(_digits(present) - _scale(present)).alias(f"whole{i}"),
    ]


def _chosen(found: dict, i: int) -> tuple[str, str]:
    """The type, and why nothing narrower."""
    n = found[f"n{i}"]
    if not n:
        return "string", "no values"
    for plain in ("boolean", "int", "bigint"):
        if not found[f"{plain}{i}"]:
            return plain, "every text is given back"
    scale, digits = found[f"most{i}"], found[f"whole{i}"] + found[f"most{i}"]
    if not found[f"decimal{i}"] and found[f"least{i}"] == scale and digits <= DECIMAL_DIGITS:
        return f"decimal({digits},{scale})", "one number of decimals"
    for plain in ("double", "date", "timestamp"):
        if not found[f"{plain}{i}"]:
            return plain, "every text is given back"
    kinds = ("boolean", "bigint", "decimal", "double", "date", "timestamp")
    nearest = min(kinds, key=lambda t: (found[f"{t}{i}"], kinds.index(t)))
    return "string", f"{found[f'{nearest}{i}']} of {n} are no {nearest}"


def inferred_types(df: DataFrame, columns: Iterable[str] | None = None, rule: Missing = EMPTY) -> dict[str, tuple[str, str]]:
    """For each text column its type and the reason; missing values fit every type.

    One pass, one row a task.  ``bigint`` beyond ``int``, decimals with one number of places after
    the point, doubles of at most 15 digits without idle zeros.
    """
    texts = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    names = [c for c in (texts if columns is None else columns)]
    if not names:
        return {}
    parts = [p for i, c in enumerate(names) for p in _parts(i, F.when(~is_missing(df, c, rule), named(c)))]
    found = df.agg(*parts).first().asDict()
    return {c: _chosen(found, i) for i, c in enumerate(names)}


def typed(df: DataFrame, rule: Missing = EMPTY, types: dict[str, tuple[str, str]] | None = None) -> DataFrame:
    """``df`` with its text columns cast to their inferred types, in which missing values are
    NULL; what stays text stays as it is."""
    types = inferred_types(df, rule=rule) if types is None else types
    changed = {
        c: F.when(~is_missing(df, c, rule), named(c)).cast("timestamp_ntz" if t == "timestamp" else t)
        for c, (t, _) in types.items()
        if t != "string"
    }
    return df.withColumns(changed)


def inferred_schema(df: DataFrame, rule: Missing = EMPTY) -> DataFrame:
    """(column, type, reason) of every column; those that are not text keep theirs."""
    found = inferred_types(df, rule=rule)
    rows = [(f.name, *found.get(f.name, (f.dataType.simpleString(), "given"))) for f in df.schema]
    return count_table(df.sparkSession, rows, "column string, type string, reason string")
