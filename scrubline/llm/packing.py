"""Best-fit packing of tokenised documents into sequences of a fixed capacity.

A document is its tokens and an end token; one that is longer than the capacity
is cut into full pieces, the first of which holds the rest.  Packing needs only
the number of pieces of each length, a table of as many rows as the capacity: by
minimum bin slack, the longest piece left is completed by the combination of
available lengths that fills the sequence most, found by subset sums over a
bitset, and the combination is taken out as often as the counts allow.  Pieces
are then ranked within their length, in two levels so that a very frequent length
is not in one task, and their rank says which sequence and offset they get.

Tokens: texts of Latin letters, digits and common signs go through the faster of
two libraries with the same vocabulary and the same splitting pattern, for which
the tests compare both; all others, and texts with the special token's string, go
through ``tokenizers`` itself.

Defined cases: a null or empty text is the end token alone; null and repeated
identifiers are documents of their own; an empty table gives an empty result;
further columns do not matter.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections.abc import Iterator
from math import isqrt

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stage, worker_value

CAPACITY, END = 1024, 2
# Above U+024F, and among control signs, the two libraries might split differently.
UNUSUAL = re.compile("[^\t\n\r\x20-\x7e\xa1-ɏ–—‘-„…€]|<\\|endoftext\\|>")


def load(vocabulary: str, ranks: str | None, pattern: str | None):
    """The tokenizer, and the faster form of the same vocabulary if there is one."""
    from tokenizers import Tokenizer

    exact, fast = Tokenizer.from_file(vocabulary), None
    if ranks:
        import tiktoken

        with open(ranks, "rb") as lines:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table, special_tokens={})
    return exact, fast


def encoder(vocabulary: str, ranks: str | None, pattern: str | None):
    """``text -> ids`` (unsigned 32 bits); loaded once per worker."""
    exact, fast = worker_value(("encoder", vocabulary, ranks), lambda: load(vocabulary, ranks, pattern))

    def encode(text: str) -> np.ndarray:
        if fast is None or UNUSUAL.search(text):
            return np.array(exact.encode(text, add_special_tokens=False).ids, np.uint32)
        return np.array(fast.encode_ordinary(text), np.uint32)

    return encode


def tokenizer_files() -> dict:
    """The files of the byte-level vocabulary, in both libraries' formats."""
    import public_tokenizers

    return {
        "vocabulary": public_tokenizers.path("byte_bpe_50k.json"),
        "ranks": public_tokenizers.path("byte_bpe_50k.tiktoken"),
        "pattern": public_tokenizers.PATTERN,
    }


def pieces(
    docs: DataFrame, kept: list[str], tokenizer: dict, text_col: str = "text", capacity: int = CAPACITY, ids: bool = False
) -> DataFrame:
    """The columns ``kept`` per piece, with ``piece``, ``start``, ``length``,
    ``ids_crc32`` and, if asked for, ``ids``."""
    rows = docs.select(F.struct(*kept).alias("row"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(**tokenizer)
        for batch in batches:
            found: list[tuple] = []
            for at, text in enumerate(batch.column("text")):
                tokens = np.append(encode(text.as_py() or ""), np.uint32(END)).astype("<u4")
                first = len(tokens) % capacity or capacity
                cuts = [0, *range(first, len(tokens) + 1, capacity)]
                for piece, (low, high) in enumerate(zip(cuts, cuts[1:])):
                    part = tokens[low:high]
                    found.append((at, piece, low, high - low, zlib.crc32(part.tobytes()), part if ids else None))
            columns = list(zip(*found)) or [[]] * 6
            out = [
                batch.column("row").take(pa.array(columns[0], pa.int64())),
                pa.array(columns[1], pa.int32()),
                *[pa.array(c, pa.int64()) for c in columns[2:5]],
            ]
            if ids:
                out.append(pa.array([p.astype(np.int32) for p in columns[5]], pa.list_(pa.int32())))
            names = ["row", "piece", "start", "length", "ids_crc32", "ids"]
            yield pa.RecordBatch.from_arrays(out, names=names[: len(out)])

    schema = f"row {rows.schema['row'].dataType.simpleString()}, piece int, start bigint, length bigint, ids_crc32 bigint"
    found = rows.mapInArrow(run, schema + (", ids array<int>" if ids else ""))
    return found.select("row.*", *found.columns[1:])


def fullest(counts: dict[int, int], capacity: int) -> list[tuple[int, int]]:
    """The combination with the longest length that leaves the least slack:
    ``(length, how often)``, longest first."""
    longest = max(counts)
    room = capacity - longest
    reach, mask, steps = 1, (1 << (room + 1)) - 1, []
    for length in sorted(counts, reverse=True):
        left = min(counts[length] - (length == longest), room // length)
        times = 1
        while left > 0 and not reach >> room & 1:
            take = min(times, left)
            steps.append((length, take, reach))
            reach |= reach << (take * length) & mask
            left -= take
            times *= 2
        if reach >> room & 1:
            break
    at = reach.bit_length() - 1
    used = {longest: 1}
    for length, take, before in reversed(steps):
        if not before >> at & 1:
            at -= take * length
            used[length] = used.get(length, 0) + take
    return sorted(used.items(), reverse=True)


def fill(counts: dict[int, int], capacity: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """Combinations that use up ``counts``: how many sequences, and of what."""
    counts = {length: n for length, n in counts.items() if n}
    result = []
    while counts:
        used = fullest(counts, capacity)
        times = min(counts[length] // n for length, n in used)
        for length, n in used:
            counts[length] -= times * n
            if not counts[length]:
                del counts[length]
        result.append((times, used))
    return result


def _slots(counts: dict[int, int], capacity: int) -> pd.DataFrame:
    """For runs of ranks within a length: first sequence, pieces per sequence, offset."""
    rows, taken, sequence = [], dict.fromkeys(counts, 0), 0
    for times, used in fill(counts, capacity):
        offset = 0
        for length, n in used:
            rows.append((length << 44 | taken[length], taken[length], sequence, n, offset, length))
            taken[length] += times * n
            offset += n * length
        sequence += times
    return pd.DataFrame(rows, columns=["key", "rank", "sequence", "n", "offset", "length"]).sort_values("key")


def pack(found: DataFrame, order: list[str], capacity: int = CAPACITY) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to pieces (a written table with ``length``).
    ``order`` are the columns that number pieces of one length."""
    counts = {r["length"]: r["count"] for r in found.groupBy("length").count().collect()}
    slots = _slots(counts, capacity).to_numpy(np.int64)
    buckets = isqrt(sum(counts.values()) // 100) + 1
    rows = found.withColumn("bucket", F.pmod(F.xxhash64(*order), F.lit(buckets)))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    base = (
        rows.groupBy("length", "bucket")
        .count()
        .select("length", "bucket", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("base"))
    )
    inside = Window.partitionBy("length", "bucket").orderBy(*order)
    ranked = (
        rows.withColumn("inside", F.row_number().over(inside) - 1)
        .join(base, ["length", "bucket"])
        .withColumn("rank", F.col("base") + F.col("inside"))
    )

    @F.pandas_udf("sequence_id bigint, offset bigint")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        at = np.searchsorted(slots[:, 0], length.to_numpy() << 44 | rank.to_numpy(), side="right") - 1
        slot = slots[at]
        nth = rank.to_numpy() - slot[:, 1]
        return pd.DataFrame(
            {"sequence_id": slot[:, 2] + nth // slot[:, 3], "offset": slot[:, 4] + nth % slot[:, 3] * slot[:, 5]}
        )

    placed = ranked.withColumn("place", place("length", "rank"))
    return placed.select(*found.columns, "place.*")


def packed_documents(
    docs: DataFrame,
    tokenizer: dict | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
    ids: bool = False,
) -> DataFrame:
    """One row per piece: identifier, ``piece``, ``start``, ``length``, ``ids_crc32``
    (and ``ids``), ``sequence_id`` and ``offset``."""
    slim = docs.select(F.col(id_col).alias("_id"), F.monotonically_increasing_id().alias("_at"), F.col(text_col).alias("text"))
    found = stage(pieces(slim, ["_id", "_at"], tokenizer or tokenizer_files(), "text", capacity, ids), "pieces")
    packed = pack(found, ["_id", "ids_crc32", "_at", "piece"], capacity)
    return packed.select(
        F.col("_id").alias(id_col),
        *[c for c in packed.columns if c not in ("_id", "_at")],
    )


def sequences(packed: DataFrame) -> DataFrame:
    """``sequence_id`` and ``ids``, the tokens of each sequence, from pieces with ``ids``.
    A sequence holds at most ``capacity`` tokens."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids"))
