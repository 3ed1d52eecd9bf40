"""Column names."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame


# Fixed value: the characters that a normal name replaces.
REPLACED = "[^a-zA-Z0-9]"


class NameCollision(ValueError):
    """Two headers have the same normal name."""


def normal_name(header: str) -> str:
    """Lower case, with ``_`` for each character but ASCII letters and digits."""
    return re.sub(REPLACED, "_", header).lower()


def normalize_columns(df: DataFrame) -> DataFrame:
    """Rename all columns to their normal names in one projection."""
    sources: dict[str, list[str]] = {}
    for header in df.columns:
        sources.setdefault(normal_name(header), []).append(header)
    clashes = {name: headers for name, headers in sources.items() if len(headers) > 1}
    if clashes:
        raise NameCollision(f"headers with the same normal name: {clashes}")
    return df.toDF(*sources)
