"""Row previews."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from scrubline.functions.missing import named
from scrubline.functions.text import show_text


def _has_order(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.ArrayType):
        return _has_order(dtype.elementType)
    if isinstance(dtype, T.StructType):
        return all(_has_order(f.dataType) for f in dtype)
    return not isinstance(dtype, (T.MapType, T.VariantType))


def preview(
    df: DataFrame, key: str, rows: int = 5, width: int | None = 20
) -> DataFrame:
    """The first rows by ``key``, ties by the other columns from the left, for display.

    A first job ranks the keys alone, so no other column is computed or moved
    for rows that are not shown.  The last key found then bounds the scan.
    Columns without an order (maps, variants) do not break ties.
    Texts longer than ``width`` are cut; ``width=None`` shows them whole.
    """
    order = named(key).asc_nulls_last()
    keys = df.select(named(key)).orderBy(order).limit(rows).collect()
    if len(keys) == rows and keys[-1][0] is not None:
        df = df.where(named(key) <= keys[-1][0])
    ties = (named(f.name).asc_nulls_last() for f in df.schema if _has_order(f.dataType))
    shown = df.orderBy(order, *ties).limit(rows)
    if not width:
        return shown
    return shown.withColumns(
        {
            f.name: show_text(named(f.name), width)
            for f in df.schema
            if isinstance(f.dataType, T.StringType)
        }
    )
