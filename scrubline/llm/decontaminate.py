"""Benchmark decontamination by a prefix-filtered set join, with DataFrame functions only.

Words are lower-cased (A-Z) runs of ASCII letters, digits and characters above U+007F.  A
window is ``window`` consecutive words of an item; an item of fewer words, but not none,
is one window.  A window's tokens are its shingles of ``shingle`` words (all its words, if
it has fewer).  A document contains a window if all its shingles follow one another there,
so the join needs a prefix of one token: the shingle that is rarest in the documents.

1. The documents' shingles that some window has are counted: one pass, aggregated before
   the shuffle.  A window with a shingle that is in no document cannot occur and goes.
2. Each window's rarest shingle (then the leftmost) is joined with the shingles of the
   documents, by hash.  A match says where the window would begin; it is kept if all its
   words lie within the document.
3. The words there are compared with the window's, one by one.

Windows that several items share are searched once.  Results are made per distinct text,
known by its SHA-256, so copies share one search result and a lost task gives the same
again.  Only texts with a match of step 2 are shuffled, each once.  Each of the three
joins sends its smaller side (hashes, prefixes, keys of texts with a match) to all tasks
if it is at most ``broadcast_mb``, which is checked, and is a sort-merge join beyond;
the rows are the same.

Bounds: a task holds one document's words.  A document's list of items is as long as the
items whose windows it has, which no way of reporting them avoids.

Defined cases: null and empty texts and texts of signs have no words, and such items no
window; a null item identifier counts as the empty one; several item rows with one
identifier are one item; rows that are repeated are documents of their own; an empty
table of items hits nothing, an empty table of documents gives an empty result; further
columns do not matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import lower_ascii, stage, text_or_empty

WINDOW, SHINGLE, BROADCAST_MB = 10, 4, 64
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# what a row of a joined table takes beside its words, at most
KEY_BYTES = 128


def word_list(text: Column) -> Column:
    return F.array_remove(F.split(lower_ascii(text_or_empty(text)), BETWEEN), "")


def item_windows(items: DataFrame, id_col: str, text_col: str, window: int) -> DataFrame:
    """``item`` (the identifier as text), ``window`` (its words, joined by blanks) and
    ``n``, the number of words; every row once."""
    ident = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    start = F.explode(F.when(F.size("w") > 0, F.sequence(F.lit(1), F.greatest(F.size("w") - (window - 1), F.lit(1)))))
    held = items.select(ident.alias("item"), word_list(F.col(text_col)).alias("w"))
    part = F.slice("w", F.col("at"), window)
    return held.select("item", "w", start.alias("at")).select("item", F.array_join(part, " ").alias("window"), F.size(part).alias("n")).distinct()


def _shingle_hash(words: Column | str, at: Column, length: int) -> Column:
    """The hash of ``length`` words from ``at`` (from 0)."""
    return F.xxhash64(*[F.get(words, at + i) for i in range(length)])


def shingles(rows: DataFrame, lengths: list[int], kept: list[str]) -> DataFrame:
    """``at`` and ``h`` of all shingles of the array ``w``, with the columns ``kept``;
    where they are of several lengths, ``h`` is null for those beyond the end."""
    shortest, n = min(lengths), F.size("w")
    at = F.explode(F.when(n >= shortest, F.sequence(F.lit(0), n - shortest)))
    placed = rows.select("w", *[c for c in kept if c != "w"], at.alias("at"))
    hashes = [
        F.when(F.col("at") + length <= n, _shingle_hash("w", F.col("at"), length)) if length > shortest
        else _shingle_hash("w", F.col("at"), length)
        for length in lengths
    ]
    h = hashes[0] if len(hashes) == 1 else F.explode(F.array(*hashes))
    return placed.select(*kept, "at", h.alias("h"))


def is_small(df: DataFrame, size: Column, broadcast_mb: float) -> bool:
    """Whether the rows of ``df``, each of ``size`` bytes, are at most ``broadcast_mb``."""
    return (df.agg(F.sum(size)).first()[0] or 0) <= broadcast_mb * 1e6


def hinted(df: DataFrame, size: Column, broadcast_mb: float) -> DataFrame:
    """``df``, to be sent to all tasks if it is small, to be merged by a shuffle if not."""
    return F.broadcast(df) if is_small(df, size, broadcast_mb) else df.hint("shuffle_merge")


def rarest(windows: DataFrame, texts: DataFrame, lengths: list[int], broadcast_mb: float) -> DataFrame:
    """``window``, ``n``, and ``h`` and ``offset`` of its rarest shingle; only windows
    whose shingles all occur in ``texts`` (column ``w``)."""
    split = windows.select("window", "n", F.split("window", " ").alias("w"))
    own = F.least("n", F.lit(max(lengths)))
    tokens = None
    for length in lengths:  # at most as many as a shingle has words
        part = shingles(split.filter(own == length), [length], ["window", "n"])
        tokens = part if tokens is None else tokens.union(part)
    tokens = stage(tokens, "shingles")
    wanted, seen = tokens.select("h").distinct(), shingles(texts, lengths, [])
    counted = F.count(F.lit(1)).alias("seen")
    if is_small(wanted, F.lit(KEY_BYTES), broadcast_mb):
        counts = seen.join(F.broadcast(wanted), "h").groupBy("h").agg(counted)
    else:  # added up before the shuffle, so a frequent shingle is one row a task
        counts = seen.groupBy("h").agg(counted).join(wanted.hint("shuffle_merge"), "h")
    best = F.min(F.struct(F.coalesce("seen", F.lit(0)).alias("seen"), F.col("at").alias("offset"), "h"))
    return (
        tokens.join(stage(counts, "shingle_counts"), "h", "left")
        .groupBy("window", "n")
        .agg(best.alias("best"))
        .filter("best.seen > 0")
        .select("window", "n", "best.h", "best.offset")
    )


def occurrences(texts: DataFrame, prefixes: DataFrame, lengths: list[int], broadcast_mb: float) -> DataFrame:
    """``key``, ``start``, ``n`` and ``window`` of every place of a window in ``texts``
    (``key`` and the words ``w``), once per key."""
    tokens = shingles(texts.withColumn("words", F.size("w")), lengths, ["key", "words"])
    start = (F.col("at") - F.col("offset")).alias("start")
    placed = tokens.join(hinted(prefixes, F.octet_length("window") + KEY_BYTES, broadcast_mb), "h")
    placed = placed.select("key", "words", start, "n", "window")
    placed = placed.filter((F.col("start") >= 0) & (F.col("start") + F.col("n") <= F.col("words")))
    placed = stage(placed.select("key", "start", "n", "window").distinct(), "matches")
    keys = hinted(placed.select("key").distinct(), F.lit(KEY_BYTES), broadcast_mb)
    held = texts.join(keys, "key", "left_semi").dropDuplicates(["key"])
    part = F.array_join(F.slice("w", F.col("start") + 1, F.col("n")), " ")
    return placed.join(held, "key").filter(part == F.col("window")).select("key", "start", "n", "window")


def words_hit(found: DataFrame) -> DataFrame:
    """``key`` and ``n_hit``, the words in any of its places."""
    places = found.groupBy("key", "start").agg(F.max(F.col("start") + F.col("n")).alias("end"))
    before = Window.partitionBy("key").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    new = F.greatest(F.col("end") - F.greatest("start", F.coalesce(F.max("end").over(before), F.lit(0))), F.lit(0))
    return places.select("key", new.alias("new")).groupBy("key").agg(F.sum("new").cast("long").alias("n_hit"))


def items_hit(found: DataFrame, held: DataFrame) -> DataFrame:
    """``key`` and ``items``, the sorted identifiers of the items that have its windows."""
    pairs = found.select("key", "window").distinct().join(held.select("window", "item"), "window")
    return pairs.groupBy("key").agg(F.array_sort(F.collect_set("item")).alias("items"))


def contamination(
    docs: DataFrame,
    items: DataFrame,
    kept: list[str],
    text_col: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    shingle: int = SHINGLE,
    broadcast_mb: float = BROADCAST_MB,
) -> DataFrame:
    """The columns ``kept`` of every document, ``n_words``, ``n_hit`` and ``items``."""
    held = stage(item_windows(items, item_id, item_text, window), "windows")
    windows = held.select("window", "n").distinct()
    lengths = sorted(r[0] for r in windows.select(F.least("n", F.lit(shingle))).distinct().collect())
    text = text_or_empty(F.col(text_col))
    key = F.unhex(F.sha2(text, 256)).alias("key")
    rows = docs.select(F.struct(*kept).alias("row"), key, F.size(word_list(text)).cast("long").alias("n_words"))
    none = F.array().cast("array<string>")
    if not lengths:
        return rows.select("row.*", "n_words", F.lit(0).cast("long").alias("n_hit"), none.alias("items"))
    texts = docs.select(key, word_list(text).alias("w"))
    prefixes = stage(rarest(windows, texts, lengths, broadcast_mb), "prefixes")
    found = stage(occurrences(texts, prefixes, lengths, broadcast_mb), "occurrences")
    hits = words_hit(found).join(items_hit(found, held), "key")
    return rows.join(hits, "key", "left").select(
        "row.*", "n_words", F.coalesce("n_hit", F.lit(0)).alias("n_hit"), F.coalesce("items", none).alias("items")
    )
