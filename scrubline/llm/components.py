"""Connected components of an edge table by alternating stars.

Each round links every node to the smallest node it knows, first among larger,
then among smaller neighbours; after a few rounds each component is one star.
All rounds are joins and aggregates; nothing is collected but a checksum.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("v", "u"))
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    return (
        both.filter("v > u")
        .join(least, "u")
        .select(F.col("v").alias("u"), F.least("u", "m").alias("v"))
        .filter("u != v")
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least).distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())


def components(edges: DataFrame) -> DataFrame:
    """``(u, v)`` for every node ``u`` that is not the smallest of its component;
    ``v`` is that smallest node.  ``edges`` has long columns ``a`` and ``b``."""
    pair = edges.filter("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    now = stage(pair.distinct(), "edges")
    state = _state(now)
    while state[0]:
        # a round gives an edge for each edge and one for each node that is not the smallest, at most
        now = stage(_small_star(_large_star(now)), "edges", at_most=2 * state[0])
        before, state = state, _state(now)
        if before == state:
            break
    return now
