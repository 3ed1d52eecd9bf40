"""Mixing sources to target weights, with DataFrame functions only.

The words of a source, document after document, are packed into blocks of
``BLOCK`` words.  A mix is a sequence of slots, each for one block, cut into output shards
of ``SHARD`` slots.  Each shard draws how many slots every source gets: a multinomial draw,
given that over all shards a source gets the slots of its target.  (A draw without that
condition would miss the target of a small source by about the square root of its slots.)
It is made by dealing all slots to places in the shards by a pseudorandom permutation.

The slots of a source are numbered over the shards.  Slot j stands for a block of epoch
``j div blocks``: another permutation for each source and epoch maps ``j mod blocks`` to
it.  Blocks and documents are then joined by block number.  Permutations are Feistel
rounds over two numbers that together count a little more than is needed; what lands
beyond goes through the rounds again.  No number in them exceeds twice their size.

Nothing depends on the order of rows or on the partitioning: a document's place
in its source follows from its identifier, draws are hashes of their numbers.
Places are prefix sums in two levels, over buckets and within a bucket, each of
about the square root of the rows, so a source with a third of all rows is never
in one task.  Sources are numbered, and their slots added up, in two levels too, over
runs of sources and within a run; to the driver come sums over all of them and one number
for each weight, so there may be as many sources as documents.

Defined cases: a null text has no words; a null source is a source, the last; a
null identifier comes first in its bucket; rows that are repeated are documents
of their own; sources without words have target 0; an empty table gives an empty
result; further columns do not matter.
"""

from __future__ import annotations

from collections.abc import Callable
from math import ceil, isqrt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import source_key, stage, words

BLOCK = 64
SHARD = 1 << 16
MAX_EPOCHS = 3
SEED = 20240229
ROUNDS, WALK, MAX_TASKS = 6, 128, 20_000


def _level(opened: Callable[[float], tuple[float, float, int]]) -> float:
    """The share of a weight of one, where shares that would be above their cap end there.
    ``opened`` gives what a level leaves to the sources that it does not fill, and their weight
    and number.  A level is never below the one before, so what is filled stays so."""
    level, before = 0.0, None
    while True:
        rest, weight, n = opened(level)
        if not n:
            return float("inf")
        if n == before:
            return level
        level, before = rest / weight, n


def targets(sizes: list[int], weights: list[float], cap: float = MAX_EPOCHS) -> list[float]:
    """Shares of the sum of ``sizes`` by weight, none above ``cap`` times its size;
    what is above is shared again by weight among the others."""

    def opened(level: float) -> tuple[float, float, int]:
        left = [i for i, (size, weight) in enumerate(zip(sizes, weights)) if cap * size >= level * weight]
        filled = sum(sizes) - sum(sizes[i] for i in left)
        return float(sum(sizes)) - cap * filled, sum(weights[i] for i in left), len(left)

    level = _level(opened)
    return [float(min(cap * size, level * weight)) for size, weight in zip(sizes, weights)]


def _places(docs: DataFrame, kept: list[str], id_col: str, text_col: str, source_col: str) -> DataFrame:
    """``kept``, ``src``, ``size`` and ``start``, the words of the source before the document."""
    buckets = isqrt(docs.count()) + 1
    rows = docs.select(
        *kept,
        F.col(id_col).alias("_id"),
        source_key(F.col(source_col)).alias("src"),
        F.size(words(F.col(text_col))).cast("long").alias("size"),
        F.pmod(F.xxhash64(id_col), F.lit(buckets)).alias("bucket"),
    )
    rows = stage(rows, "sizes")
    sums = rows.groupBy("src", "bucket").agg(F.sum("size").alias("words"))
    before = Window.partitionBy("src").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    base = sums.select("src", "bucket", F.coalesce(F.sum("words").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("src", "bucket").orderBy("_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    return (
        rows.withColumn("inside", F.sum("size").over(inside) - F.col("size"))
        .join(base, ["src", "bucket"])
        .select(*kept, "src", "size", (F.col("base") + F.col("inside")).alias("start"))
    )


def permuted(i: Column, n: Column, *key: Column) -> Column:
    """A pseudorandom permutation of the numbers below ``n``, another one for each ``key``."""
    # high * low is at least n, and at most the square root of n more
    high = F.ceil(F.sqrt(n.cast("double"))).cast("long")
    low = F.floor((n + high - 1) / high)

    def rounds(x: Column) -> Column:
        left, right = F.floor(x / low), F.pmod(x, low)
        for step in range(0, ROUNDS, 2):
            left = F.pmod(left + F.pmod(F.xxhash64(right, F.lit(step), *key), high), high)
            right = F.pmod(right + F.pmod(F.xxhash64(left, F.lit(step + 1), *key), low), low)
        return left * low + right

    first = rounds(i)
    # no path outside is longer than the numbers there, and long ones are beyond chance
    again = F.sequence(F.lit(1), F.least(high * low - n + 1, F.lit(WALK)).cast("int"))
    inside = F.aggregate(again, first, lambda x, _: F.when(x < n, x).otherwise(rounds(x)))
    return F.when(first < n, first).otherwise(inside)


def _before(sources: DataFrame, value: Column, name: str) -> DataFrame:
    """Adds ``name``, the sum of ``value`` over the sources before.  ``part`` numbers the runs
    of sources."""
    runs = sources.groupBy("part").agg(F.sum(value).alias("all"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = runs.select("part", F.coalesce(F.sum("all").over(earlier), F.lit(0)).alias("base"))
    inside = Window.partitionBy("part").orderBy("src").rowsBetween(Window.unboundedPreceding, -1)
    # as many rows as there are partitions
    rows = sources.withColumn(name, F.coalesce(F.sum(value).over(inside), F.lit(0))).join(F.broadcast(base), "part")
    return rows.withColumn(name, F.col("base") + F.col(name)).drop("base")


def source_plan(places: DataFrame, weights: list[float], block: int, cap: float = MAX_EPOCHS) -> DataFrame:
    """One row per source with words or without: ``part`` (runs in code point order, null
    last), ``src``, ``size``, ``target``, ``blocks`` and ``slots``."""
    sums = places.groupBy("src").agg(F.sum("size").alias("size"))
    dealt = stage(sums.repartitionByRange("src").withColumn("part", F.spark_partition_id()), "source_sizes")
    which = F.pmod(F.col("i"), F.lit(len(weights))).cast("int").alias("which")
    sources = stage(_before(dealt, F.lit(1), "i").select("part", "src", "size", which), "sources")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.col("which") + 1)
    total = sources.agg(F.sum("size")).first()[0] or 0

    def is_open(level: float) -> Column:
        return F.col("size") * cap >= F.lit(level) * weight

    def opened(level: float) -> tuple[float, float, int]:
        sums = sources.groupBy("which").agg(F.count_if(is_open(level)).alias("n"), F.sum(F.when(~is_open(level), F.col("size"))).alias("filled"))
        by = sums.orderBy("which").collect()
        return float(total) - cap * sum(r["filled"] or 0 for r in by), sum(r["n"] * weights[r["which"]] for r in by), sum(r["n"] for r in by)

    level = _level(opened)
    target = F.when(is_open(level), F.lit(level) * weight).otherwise(F.col("size") * cap).cast("double")
    plan = sources.select("part", "src", "size", target.alias("target"), F.expr(f"(size + {block - 1}) div {block}").alias("blocks"))
    slots = F.when(F.col("size") > 0, F.col("target") / F.col("size") * F.col("blocks")).otherwise(0.0)
    return stage(plan.withColumn("slots", slots), "source_plan")


def _slots(spark, plan: DataFrame | list[dict]) -> tuple[DataFrame, int]:
    """The sources of a plan with whole ``slots`` and those ``before``; and the sum of all.  A
    list is a plan of few sources, in order."""
    if isinstance(plan, list):
        plan = spark.createDataFrame([(0, p["src"], p["blocks"], float(p["slots"])) for p in plan], "part int, src string, blocks long, slots double")
    slots = F.least(F.rint("slots").cast("long"), F.col("blocks") * MAX_EPOCHS).alias("slots")
    sources = plan.select("part", "src", "blocks", slots)
    return _before(sources, F.col("slots"), "before"), sources.agg(F.sum("slots")).first()[0] or 0


def _counts(sources: DataFrame, total: int, shard: int) -> DataFrame:
    # a source's slots in runs, so that a large source is many rows
    last = F.expr(f"(slots - 1) div {shard}")
    runs = sources.filter("slots > 0").select("*", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("run"))
    runs = runs.repartition(_tasks(total, shard), "src", "run")
    upto = F.least("slots", (F.col("run") + 1) * shard) - 1
    slots = runs.select("src", "blocks", "before", F.explode(F.sequence(F.col("run") * shard, upto)).alias("slot"))
    place = permuted(F.col("before") + F.col("slot"), F.lit(total).cast("long"), F.lit(SEED))
    drawn = slots.select("src", "blocks", F.floor(place / shard).alias("shard")).groupBy("src", "blocks", "shard").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("src").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return drawn.withColumn("first", F.coalesce(F.sum("n").over(before), F.lit(0)))


def shard_counts(spark, plan: DataFrame | list[dict], shard: int = SHARD) -> DataFrame:
    """``src``, ``blocks``, ``shard``, ``first`` and ``n``: the slots that each shard draws for a
    source are its slots from ``first`` on, ``n`` of them."""
    return _counts(*_slots(spark, plan), shard)


def _tasks(slots: int, shard: int) -> int:
    """Tasks for the slots: their own number, as the rows they are made from look few."""
    return min(MAX_TASKS, max(1, ceil(slots / (4 * shard))))


def block_uses(spark, plan: DataFrame | list[dict], shard: int = SHARD) -> DataFrame:
    """``src``, ``block`` and ``uses``: how often the mix takes each block it takes."""
    sources, total = _slots(spark, plan)
    counts = _counts(sources, total, shard).repartition(_tasks(total, shard), "src", "shard")
    slots = counts.select("src", "blocks", F.explode(F.sequence(F.col("first"), F.col("first") + F.col("n") - 1)).alias("slot"))
    epoch, at = F.expr("slot div blocks"), F.pmod("slot", "blocks")
    block = permuted(at, F.col("blocks"), F.col("src"), epoch, F.lit(SEED))
    uses = slots.select("src", block.alias("block")).groupBy("src", "block").agg(F.count(F.lit(1)).alias("uses"))
    # as many rows as the mix takes blocks: not to be sent, however few the counts were
    return uses.hint("shuffle_merge")


def _pieces(places: DataFrame, kept: list[str], block: int) -> DataFrame:
    """A row per document and block it reaches into: first word in the document, and words."""
    last = F.expr(f"(start + size - 1) div {block}")
    reach = places.filter("size > 0").select(
        *kept, "src", "size", "start", F.explode(F.sequence(F.expr(f"start div {block}"), last)).alias("block")
    )
    low = F.greatest("start", F.col("block") * block)
    high = F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * block)
    return reach.select(*kept, "src", "block", (low - F.col("start")).alias("first"), (high - low).alias("words"))


def mix(
    docs: DataFrame,
    weights: list[float],
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    block: int = BLOCK,
) -> DataFrame:
    """One row per document: identifier, ``size`` in words, ``source_size``,
    ``target`` (its source's) and ``taken``, the words the mix takes of it,
    repeats counted.  The sources in code point order, null last, weigh
    ``weights``, repeated as often as needed."""
    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(source_col).alias("source"))
    slim = slim.withColumn("at", F.monotonically_increasing_id())
    places = stage(_places(slim, ["id", "at"], "id", "text", "source"), "places", at_most=docs.count())
    plan = source_plan(places, weights, block)
    taken = (
        _pieces(places, ["at"], block)
        .join(block_uses(docs.sparkSession, plan), ["src", "block"])
        .groupBy("at")
        .agg(F.sum(F.col("words") * F.col("uses")).alias("taken"))
    )
    sources = plan.select("src", F.col("size").alias("source_size"), "target")
    if plan.count() <= 10_000:
        sources = F.broadcast(sources)
    return (
        places.join(taken, "at", "left")
        .join(sources, "src")
        .select(
            F.col("id").alias(id_col), "size", "source_size", "target", F.coalesce("taken", F.lit(0)).alias("taken")
        )
    )


def mixed_documents(
    docs: DataFrame,
    weights: list[float],
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    length_col: str | None = "n_chars",
    block: int = BLOCK,
) -> DataFrame:
    """The mix as documents, with the columns of ``docs``: for each time that
    blocks of a document are taken a row with the words of these blocks, joined
    by blanks.  ``length_col`` becomes the length of that text."""
    rows = stage(docs.select(F.struct("*").alias("row"), F.monotonically_increasing_id().alias("at")), "documents")
    slim = rows.select(
        F.col(f"row.`{id_col}`").alias("id"),
        F.col(f"row.`{text_col}`").alias("text"),
        F.col(f"row.`{source_col}`").alias("source"),
        "at",
    )
    places = stage(_places(slim, ["at"], "id", "text", "source"), "places", at_most=rows.count())
    uses = block_uses(docs.sparkSession, source_plan(places, weights, block))
    spans = (
        _pieces(places, ["at"], block)
        .join(uses, ["src", "block"])
        .select("at", F.explode(F.sequence(F.lit(1), F.col("uses").cast("int"))).alias("time"), "first", "words")
        .groupBy("at", "time")
        .agg(F.array_sort(F.collect_list(F.struct("first", "words"))).alias("spans"))
    )

    def taken(w: Column) -> Column:
        cut = F.transform("spans", lambda s: F.slice(w, (s["first"] + 1).cast("int"), s["words"].cast("int")))
        return F.array_join(F.flatten(cut), " ")

    # the words are an element of an array, so that they are split once and not for each span
    split = F.array(words(F.col(f"row.`{text_col}`")))
    new = rows.join(spans, "at").select("row", F.element_at(F.transform(split, taken), 1).alias("new"))
    changed = {text_col: F.col("new")}
    if length_col in docs.columns:
        changed[length_col] = F.length("new").cast(docs.schema[length_col].dataType)
    return new.select(*[changed.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])
