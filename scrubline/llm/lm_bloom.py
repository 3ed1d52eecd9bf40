"""Language-model scores from a Bloom filter of quantised counts.

Words are lower-cased (A-Z) and split at white space; every text ends with an end
token.  The model counts tokens, exactly, and bigrams, of which the first in a text
has a start sign as its left part.  A bigram's count is quantised on a logarithmic
scale and its levels 1 up to its own are put into a Bloom filter; a probe asks for
level after level until one is missing, so errors only ever raise a count.  The
filter is made of segments by key, filled in the tasks that hold their bigrams, and
is as large as the number of levels asks for.  The probability of a token is

    (q + MASS * p1) / (c + MASS)

with the quantised count q of the bigram, rounded down so that a context's
probabilities do not add up to more than one, the count c of the left part and the
token's add-one probability p1.

The filter and the token counts are sent to all workers if together they take at
most ``broadcast_mb``.  A larger model stays where its segments are: the different
tokens and bigrams of each chunk of texts go to their segments by a shuffle, probe the
same filter there, and the answers go back to the chunk.  Filter, formula and scores
are the same; only the way to the filter differs.

Defined cases: a null or empty text is the end token alone; a null identifier
counts as the empty text when documents are held out; rows that are repeated are
documents of their own; without training documents every token is unknown; an empty
table gives an empty result; further columns do not matter.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from math import ceil, log

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stage, worker_value
from .ngrams import Lookup, before, mix, per_text, text_chunks

BASE, HASHES, SEGMENT_BITS, MASS = 1.5, 8, 12, 500.0
BROADCAST_MB = 512
COUNT_BYTES = 16 << 20
SEGMENTS = 1 << SEGMENT_BITS
# the smallest count of each level
LEVELS = sorted({ceil(BASE**i - 1e-9) for i in range(ceil(63 * log(2) / log(BASE)))})
LEVELS = [n for n in LEVELS if n < 1 << 62]
_ONE = np.uint64(1)


def held_out(ident: Column, folds: int = 7, fold: int = 2) -> Column:
    """Whether crc32 of the identifier as text leaves ``fold``."""
    return F.crc32(F.coalesce(ident.cast("string"), F.lit("")).cast("binary")) % folds == fold


def token_keys(keys: np.ndarray) -> np.ndarray:
    return keys & ~_ONE


def bigram_keys(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return mix(left, right) | _ONE


def count_grams(texts: DataFrame) -> DataFrame:
    """``segment``, ``key`` and ``n``: the counts of tokens (even keys) and bigrams
    (odd keys) of the column ``text``, with all keys of a segment in one partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for keys, ends in text_chunks((t.as_py() for t in batch.column("text")), size=COUNT_BYTES):
                for grams in (token_keys(keys), bigram_keys(before(keys, ends), keys)):
                    key, n = np.unique(grams, return_counts=True)
                    segment = (key >> np.uint64(64 - SEGMENT_BITS)).astype(np.int32)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(segment), pa.array(key.view(np.int64)), pa.array(n)], names=["segment", "key", "n"]
                    )

    rows = texts.select(F.col("text").cast("binary").alias("text")).mapInArrow(run, "segment int, key long, n long")
    return rows.repartition("segment").groupBy("segment", "key").agg(F.sum("n").alias("n"))


def is_bigram() -> Column:
    return F.col("key").bitwiseAND(F.lit(1)) == 1


def _positions(keys: np.ndarray, level: int, bits: int) -> Iterator[np.ndarray]:
    """The bits of ``level`` of each key within a segment of ``bits`` bits, one after another."""
    x = (keys + np.uint64(level * 0x9E3779B97F4A7C15 % (1 << 64))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
    low, half, size = np.uint64(0xFFFFFFFF), np.uint64(32), np.uint64(bits)
    at, step = x & low, (x >> half) | _ONE
    for _ in range(HASHES):
        yield at * size >> half
        at = (at + step) & low


def segment_row(keys: np.ndarray, n: np.ndarray, bits: int) -> np.ndarray:
    """The ``bits / 8`` bytes of one segment, from its bigrams' keys and counts."""
    levels = np.searchsorted(LEVELS, n, side="right")
    cells = np.zeros(bits, bool)
    for level in range(1, int(levels.max(initial=0)) + 1):
        keys, levels = keys[levels >= level], levels[levels >= level]
        for at in _positions(keys, level, bits):
            cells[at] = True
    return np.packbits(cells, bitorder="little")


def filter_table(counts: DataFrame, bits: int) -> DataFrame:
    """The filter: ``segment`` and ``bits``, its ``bits / 8`` bytes.  Rows of one segment add up."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = list(batches)  # of one task
        if not held:
            return
        segment, keys, n = (
            np.concatenate([b.column(c).to_numpy() for b in held]) for c in ("segment", "key", "n")
        )
        order = np.argsort(segment, kind="stable")
        segment, keys, n = segment[order], keys[order].view(np.uint64), n[order]
        first = np.flatnonzero(np.append(True, segment[1:] != segment[:-1]))
        for low, high in zip(first, np.append(first[1:], len(segment))):
            packed = segment_row(keys[low:high], n[low:high], bits).tobytes()
            yield pa.RecordBatch.from_arrays([pa.array(segment[low : low + 1]), pa.array([packed])], names=["segment", "bits"])

    grams = counts.filter(is_bigram()).select("segment", "key", "n")
    return grams.mapInArrow(run, "segment int, bits binary")


def filter_segments(counts: DataFrame, bits: int) -> np.ndarray:
    """The whole filter, a row for each segment.  Its size was checked before."""
    table = np.zeros((SEGMENTS, bits // 8), np.uint8)
    found = filter_table(counts, bits).toArrow()
    for segment, part in zip(found["segment"].to_pylist(), found["bits"]):
        table[segment] |= np.frombuffer(part.as_buffer(), np.uint8)
    return table


def probe(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """The quantised counts of bigram keys; zero for those never seen.  ``table`` holds
    all segments, or the one that all keys belong to."""
    bits, last = table.shape[1] * 8, np.uint64(len(table) - 1)
    flat = table.reshape(-1)
    level = np.zeros(len(keys), np.int64)
    left = np.arange(len(keys))
    for now in range(1, len(LEVELS) + 1):
        base = (keys[left] >> np.uint64(64 - SEGMENT_BITS) & last) * np.uint64(bits // 8)
        x, hit = keys[left], np.arange(len(left))
        for at in _positions(x, now, bits):
            at = at[hit]
            hit = hit[(flat[base[hit] + (at >> np.uint64(3))] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1]
        left = left[hit]
        if not len(left):
            break
        level[left] = now
    return np.append(0, LEVELS)[level]


def _score_chunk(model: dict, keys: np.ndarray, ends: np.ndarray) -> list[np.ndarray]:
    c = model["tokens"](token_keys(keys))
    starts = np.concatenate([[0], ends[:-1]])
    context = np.empty_like(c)
    context[1:] = c[:-1]
    context[starts] = model["documents"]
    p1 = (c + 1) / (model["total"] + model["distinct"] + 1)
    # frequent bigrams have many levels and many places, so each is probed once
    grams, place = np.unique(bigram_keys(before(keys, ends), keys), return_inverse=True)
    q = model["bigrams"](grams)[place]
    # q <= c holds but for the filter's errors
    q = np.minimum(q, np.minimum(c, context))
    p = (q + MASS * p1) / (context + MASS)
    counts = np.diff(ends, prepend=0)
    return [counts, per_text((c > 0).astype(np.int64), ends), per_text(np.log10(p1), ends), per_text(np.log10(p), ends)]


def _scored_schema(rows: DataFrame) -> str:
    return f"row {rows.schema['row'].dataType.simpleString()}, n_tokens long, n_known long, base_score double, score double"


def _score_with_filter(rows: DataFrame, model: dict) -> DataFrame:
    name, sent = uuid.uuid4().hex, rows.sparkSession.sparkContext.broadcast(model)

    def with_lookups(model: dict) -> dict:
        return model | {"tokens": Lookup(*model["tokens"]), "bigrams": lambda grams: probe(model["filter"], grams)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = worker_value(("bloom", name), lambda: with_lookups(sent.value))
        for batch in batches:
            low = 0
            for keys, ends in text_chunks(t.as_py() for t in batch.column("text")):
                out = _score_chunk(held, keys, ends)
                part = batch.column("row").slice(low, len(ends))
                low += len(ends)
                yield pa.RecordBatch.from_arrays(
                    [part, *map(pa.array, out)], names=["row", "n_tokens", "n_known", "base_score", "score"]
                )

    return rows.mapInArrow(run, _scored_schema(rows)).select("row.*", "n_tokens", "n_known", "base_score", "score")


def _asked(keys: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The different keys whose counts a chunk of texts needs, by segment."""
    return np.unique(np.concatenate([token_keys(keys), bigram_keys(before(keys, ends), keys)]))


def _score_at_segments(rows: DataFrame, counts: DataFrame, bits: int, model: dict) -> DataFrame:
    """The same scores for a filter of any size: no task holds more of it than a segment."""
    row_type = rows.schema["row"].dataType

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Of each chunk its texts, and for each segment the keys it asks there."""
        chunk = TaskContext.get().partitionId() << 32
        for batch in batches:
            low = 0
            for keys, ends in text_chunks((t.as_py() for t in batch.column("text")), size=COUNT_BYTES):
                part = batch.slice(low, len(ends))
                low += len(ends)
                asked = _asked(keys, ends)
                segment, first = np.unique((asked >> np.uint64(64 - SEGMENT_BITS)).astype(np.int32), return_index=True)
                split = [a.tobytes() for a in np.split(asked, first[1:])]
                for size, columns in (
                    (len(ends), [pa.nulls(len(ends), pa.int32()), pa.nulls(len(ends), pa.binary()), part.column("row"), part.column("text")]),
                    (len(split), [pa.array(segment), pa.array(split), pa.nulls(len(split), part.column("row").type), pa.nulls(len(split), part.column("text").type)]),
                ):
                    columns = [pa.array(np.full(size, chunk)), *columns]
                    yield pa.RecordBatch.from_arrays(columns, names=["chunk", "segment", "keys", "row", "text"])
                chunk += 1

    def answer(asked: pa.Table, known: pa.Table) -> pa.Table:
        row = np.zeros((1, bits // 8), np.uint8)
        for part in known["bits"].drop_null():
            row |= np.frombuffer(part.as_buffer(), np.uint8)
        exact = known.filter(known["bits"].is_null())
        keys, n = (exact[c].to_numpy().astype(np.int64) for c in ("key", "n"))
        tokens = Lookup(keys.view(np.uint64), n)
        parts = [np.frombuffer(part.as_buffer(), np.uint64) for part in asked["keys"]]
        wanted = np.concatenate([np.zeros(0, np.uint64), *parts])
        grams = wanted & _ONE == 1
        values = np.empty(len(wanted), np.int64)
        values[grams], values[~grams] = probe(row, wanted[grams]), tokens(wanted[~grams])
        found = [v.tobytes() for v in np.split(values, np.cumsum([len(p) for p in parts])[:-1])] if parts else []
        return pa.table({"chunk": asked["chunk"], "segment": asked["segment"], "found": pa.array(found, pa.binary())})

    def score_chunk(texts: pa.Table, answers: pa.Table) -> pa.Table:
        [(keys, ends)] = text_chunks((t.as_py() for t in texts["text"]), size=1 << 62)
        asked, parts = _asked(keys, ends), answers.sort_by("segment")["found"]
        n = np.concatenate([np.frombuffer(part.as_buffer(), np.int64) for part in parts])

        def value(keys: np.ndarray) -> np.ndarray:
            return n[np.searchsorted(asked, keys)]

        out = _score_chunk(model | {"tokens": value, "bigrams": value}, keys, ends)
        return pa.table([texts["row"], *map(pa.array, out)], names=["row", "n_tokens", "n_known", "base_score", "score"])

    schema = f"chunk long, segment int, keys binary, row {row_type.simpleString()}, text binary"
    chunks = stage(rows.mapInArrow(ask, schema), "chunks")
    asked = chunks.filter("segment is not null").select("chunk", "segment", "keys")
    tokens = counts.filter(~is_bigram()).select("segment", F.lit(None).cast("binary").alias("bits"), "key", "n")
    known = tokens.unionByName(filter_table(counts, bits), allowMissingColumns=True)
    # a segment without training grams still answers: none are known
    answers = asked.groupBy("segment").cogroup(known.groupBy("segment")).applyInArrow(answer, "chunk long, segment int, found binary")
    texts = chunks.filter("segment is null").select("chunk", "row", "text")
    scored = texts.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(score_chunk, _scored_schema(rows))
    return scored.select("row.*", "n_tokens", "n_known", "base_score", "score")


def score(
    docs: DataFrame, training: Column, kept: list[str], text_col: str = "text", broadcast_mb: int = BROADCAST_MB
) -> DataFrame:
    """The columns ``kept`` of every document, ``n_tokens``, ``n_known``,
    ``train_tokens``, ``base_score`` and ``score``.  ``training`` says from which
    rows to learn; scores are log10 probabilities of whole texts."""
    train = docs.filter(training)
    counts = stage(count_grams(train.select(F.col(text_col).alias("text"))), "counts")
    # as many rows as there are different counts, each of which takes as many words to make
    sizes = counts.groupBy(is_bigram().alias("bigram"), "n").count().toPandas()
    own = sizes[~sizes["bigram"].astype(bool)]
    total, distinct = int((own["n"] * own["count"]).sum()), int(own["count"].sum())
    grams = sizes[sizes["bigram"].astype(bool)]
    levels = int((np.searchsorted(LEVELS, grams["n"].to_numpy(np.int64), side="right") * grams["count"]).sum())
    documents = train.count()
    # eight hash bits a level at half of the bits set
    bits = 8 * ceil(levels * HASHES / log(2) / SEGMENTS / 8 + 8)
    rows = docs.select(
        F.struct(*kept, F.monotonically_increasing_id().alias("_at")).alias("row"),
        F.col(text_col).cast("binary").alias("text"),
    )
    model = {"documents": documents, "total": total, "distinct": distinct}
    if (SEGMENTS * bits / 8 + 16 * distinct) / 1e6 <= broadcast_mb:
        known = counts.filter(~is_bigram()).select("key", "n").toArrow()
        tokens = known["key"].to_numpy().astype(np.int64).view(np.uint64), known["n"].to_numpy().astype(np.int64)
        scored = _score_with_filter(rows, model | {"tokens": tokens, "filter": filter_segments(counts, bits)})
    else:
        scored = _score_at_segments(rows, counts, bits, model)
    return scored.select(*kept, "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"), "base_score", "score")
