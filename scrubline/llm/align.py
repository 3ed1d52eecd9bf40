"""Alignment of two tokenizers' tokens, with counts of the pairs of identifiers they link.

Both tokenizers encode a blank and the text.  Byte offsets where a token of either ends
cut the tokens into groups; every token A of a group is linked with every token B of it.
A pair's count is the number of documents that hold it linked.

Most groups are one token of each, which then have the same bytes.  ``Pair.same`` is an
array from every A identifier to the B identifier with the same bytes, made once per
worker.  Links that it foretells are counted in vectors as long as A's vocabulary, one a
task, without any shuffle of pairs.  All other links are irregular: their pairs are
counted per chunk of texts and go, hashed into segments, through one shuffle; a segment
adds up its counts and answers each chunk with the totals of the pairs it asked for.
Each chunk's documents then meet its answers.  A pair is one number a chunk, however many
of its documents hold it; the number of segments follows the number of asked pairs.

Driver and broadcasts hold two vectors as long as A's vocabulary, whatever the input.
Nothing else is collected.  A task holds a chunk (``CHUNK_BYTES`` of text, or one longer
document) or a segment.

Bytes: A's entries are byte-level decoded; B's are pieces with U+2581 for the blank, or
single bytes.  Special tokens' strings in a text are ordinary text.

Defined cases: null and empty texts have no tokens, nor have texts whose tokens of A or B
joined are not the blank and the text (B may normalise), invalid UTF-8 included: zeros and
no groups; repeated rows and rows without identifier are documents of their own; an empty
table gives an empty result; further columns do not matter.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage, worker_value
from .packing import UNUSUAL, load

CHUNK_BYTES, SEGMENT_PAIRS, LINKS_AT_ONCE, TEXTS_AT_ONCE = 3 << 20, 2 << 20, 1 << 20, 64
BITS = np.uint64(16)  # of a B identifier within a pair


def tokenizer_files() -> dict:
    """The byte-level vocabulary in two formats and the piece vocabulary."""
    import public_tokenizers

    return {
        "vocabulary": public_tokenizers.path("byte_bpe_50k.json"),
        "ranks": public_tokenizers.path("byte_bpe_50k.tiktoken"),
        "pattern": public_tokenizers.PATTERN,
        "pieces": public_tokenizers.path("piece_bpe_32k.model"),
    }


def byte_signs() -> dict[str, int]:
    """The byte of each sign of a byte-level vocabulary: visible Latin-1 signs stand for
    themselves, the other bytes for the signs from U+0100 on, in order."""
    visible = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xFF and b != 0xAD]
    hidden = [b for b in range(256) if b not in visible]
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Pair:
    """Both tokenizers, their tokens' bytes, and the identity map."""

    def __init__(self, vocabulary: str, ranks: str | None, pattern: str | None, pieces: str):
        import sentencepiece

        self.exact, self.fast = load(vocabulary, ranks, pattern)
        self.exact.encode_special_tokens = True
        self.model = sentencepiece.SentencePieceProcessor(model_file=pieces)
        with open(vocabulary, encoding="utf-8") as file:
            entries = json.load(file)["model"]["vocab"]
        size = self.exact.get_vocab_size()
        sign = byte_signs()
        self.a_bytes = [b""] * size
        for entry, i in entries.items():
            if all(c in sign for c in entry):
                self.a_bytes[i] = bytes(sign[c] for c in entry)
        m = self.model
        self.b_bytes = [
            bytes([int(m.id_to_piece(i)[3:5], 16)]) if m.is_byte(i) else m.id_to_piece(i).replace("▁", " ").encode()
            for i in range(m.get_piece_size())
        ]
        self.a_len, self.b_len = (np.array([len(x) for x in table], np.int64) for table in (self.a_bytes, self.b_bytes))
        whole = {x: i for i, x in enumerate(self.b_bytes) if not m.is_byte(i)}
        single = {x: i for i, x in enumerate(self.b_bytes) if m.is_byte(i)}
        self.same = np.array([whole.get(x, single.get(x, -1)) for x in self.a_bytes], np.int64)
        self.written = [b"%d%s" % (i, end) for i in range(max(size, len(self.b_bytes))) for end in (b",", b"|", b";")]

    def encode(self, texts: list[bytes | None]) -> Iterator[tuple[list[int], list[int]]]:
        """The identifiers of both tokenizers; none where their bytes are not the text's."""
        for low in range(0, len(texts), TEXTS_AT_ONCE):
            yield from self._encode(texts[low : low + TEXTS_AT_ONCE])

    def _encode(self, texts: list[bytes | None]) -> Iterator[tuple[list[int], list[int]]]:
        plain = [(t or b"").decode("utf-8", "replace") for t in texts]
        for raw, text, b in zip(texts, plain, self.model.encode(plain, num_threads=1)):
            if not raw:
                yield [], []
                continue
            unusual = self.fast is None or UNUSUAL.search(text)
            a = self.exact.encode(" " + text, add_special_tokens=False).ids if unusual else self.fast.encode_ordinary(" " + text)
            want = b" " + raw
            right = b"".join(map(self.a_bytes.__getitem__, a)) == want and b"".join(map(self.b_bytes.__getitem__, b)) == want
            yield (a, b) if right else ([], [])


def pair_of(tokenizers: dict) -> Pair:
    return worker_value(("pair", *sorted(tokenizers.items())), lambda: Pair(**tokenizers))


def _sums(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The sums of the runs of ``values`` that end at ``ends``."""
    total = np.append(0, np.cumsum(values))
    return np.diff(total[ends], prepend=0)


def cut(a_end: np.ndarray, b_end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How many tokens of A and of B are before the end of each group."""
    size = int(a_end[-1]) + 1 if len(a_end) else 1
    at = np.zeros(size, bool)
    at[a_end] = True
    b_last = np.flatnonzero(at[b_end])
    at[:] = False
    at[b_end] = True
    return np.flatnonzero(at[a_end]) + 1, b_last + 1


def links(a: np.ndarray, b: np.ndarray, a_stop: np.ndarray, b_stop: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different pairs of each document and how many links each has, as sorted keys
    ``document << 32 | a << 16 | b``.  ``doc`` is each group's document."""
    a_from, b_from = np.append(0, a_stop[:-1]), np.append(0, b_stop[:-1])
    na, nb = a_stop - a_from, b_stop - b_from
    size = na * nb
    high = doc.astype(np.uint64) << np.uint64(32)

    def pair(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return left.astype(np.uint64) << BITS | right

    parts: list[tuple[np.ndarray, np.ndarray]] = []
    one = size == 1
    parts.append(_counted(high[one] | pair(a[a_from[one]], b[b_from[one]])))
    for g in np.flatnonzero(size > LINKS_AT_ONCE):
        # a long group: different identifiers first
        ua, ca = np.unique(a[a_from[g] : a_stop[g]], return_counts=True)
        ub, cb = np.unique(b[b_from[g] : b_stop[g]], return_counts=True)
        parts.append(((high[g] | pair(ua[:, None], ub[None, :])).ravel(), (ca[:, None] * cb[None, :]).ravel()))
    rest = np.flatnonzero((size > 1) & (size <= LINKS_AT_ONCE))
    blocks = np.cumsum(size[rest]) // LINKS_AT_ONCE
    for group in np.split(rest, np.flatnonzero(np.diff(blocks)) + 1):
        n = size[group]
        at = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        wide = np.repeat(nb[group], n)
        left = a[np.repeat(a_from[group], n) + at // wide]
        parts.append(_counted(np.repeat(high[group], n) | pair(left, b[np.repeat(b_from[group], n) + at % wide])))
    keys, times = (np.concatenate(x) for x in zip(*parts))
    return _counted(keys, times)


def _counted(keys: np.ndarray, times: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The different keys in order, and how often each occurs, or the sum of its ``times``."""
    if times is None:
        return np.unique(keys, return_counts=True)
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(times[order], first) if len(first) else np.zeros(0, np.int64)


class Chunk:
    """The alignment of some texts: counts of each, and its different pairs."""

    def __init__(self, texts: list[bytes | None], pair: Pair):
        ids: list[list] = [[], []]
        counts = np.zeros((2, len(texts)), np.int64)
        for i, both in enumerate(pair.encode(texts)):
            for side in (0, 1):
                ids[side].append(np.array(both[side], np.uint32))
                counts[side, i] = len(both[side])
        empty = [np.zeros(0, np.uint32)]
        self.a, self.b = (np.concatenate(x + empty) for x in ids)
        del ids
        self.n_a, self.n_b = counts
        ends = [np.cumsum(table[x]) for table, x in ((pair.a_len, self.a), (pair.b_len, self.b))]
        self.a_stop, self.b_stop = cut(*ends)
        # groups never cross documents, as both tokenizers end with each
        stops = np.searchsorted(self.a_stop, np.cumsum(self.n_a), side="right")
        self.n_groups = np.diff(stops, prepend=0)
        doc = np.repeat(np.arange(len(texts)), self.n_groups)
        self.group_ends = stops
        size = np.diff(self.a_stop, prepend=0) * np.diff(self.b_stop, prepend=0)
        self.n_links = _sums(size, stops)
        keys, self.times = links(self.a, self.b, self.a_stop, self.b_stop, doc)
        self.doc, self.pairs = (keys >> np.uint64(32)).astype(np.int64), keys & np.uint64(0xFFFFFFFF)
        a = (self.pairs >> BITS).astype(np.int64)
        self.regular = pair.same[a] == (self.pairs & np.uint64(0xFFFF)).astype(np.int64)

    def written(self, pair: Pair) -> Iterator[bytes]:
        """The groups of each text, ``a1,a2|b1;a3|b2,b3``."""
        na, nb = np.diff(self.a_stop, prepend=0), np.diff(self.b_stop, prepend=0)
        code = np.empty(len(self.a) + len(self.b), np.int64)
        a_code, b_code = self.a.astype(np.int64) * 3, self.b.astype(np.int64) * 3
        a_code[self.a_stop - 1] += 1
        b_code[self.b_stop - 1] += 2
        # within a group the tokens of A come first
        code[np.arange(len(self.a)) + np.repeat(self.b_stop - nb, na)] = a_code
        code[np.arange(len(self.b)) + np.repeat(self.a_stop, nb)] = b_code
        ends = np.cumsum(self.n_a + self.n_b)
        for low, high in zip(np.append(0, ends[:-1]), ends):
            yield b"".join(map(pair.written.__getitem__, code[low:high].tolist()))[:-1]

    def by_text(self, chosen: np.ndarray, values: np.ndarray) -> Iterator[bytes]:
        """The bytes of the chosen entries of ``values`` of each text."""
        ends = np.cumsum(np.bincount(self.doc[chosen], minlength=len(self.n_a)))
        held = values[chosen]
        return (held[low:high].tobytes() for low, high in zip(np.append(0, ends[:-1]), ends))


DOC = "chunk long, row {row}, n_a long, n_b long, n_groups long, n_links long, groups string, own binary, own_n binary, odd binary, odd_n binary"
ALIGNED = DOC + ", pairs binary, pair_docs binary, n_pairs long, vector array<int>"


def aligned_texts(
    docs: DataFrame, kept: list[str], text_col: str = "text", tokenizers: dict | None = None, digest: bool = False
) -> DataFrame:
    """The alignment as a written table of three kinds of rows: documents (``row``, the
    columns ``kept``; counts; ``groups`` as text, or its SHA-256 for ``digest``; the
    different regular and irregular pairs as numbers), chunks (``pairs``: irregular pairs and in
    how many of its documents they are) and tasks (``vector``: documents of each regular pair)."""
    tokenizers = tokenizers or tokenizer_files()
    rows = docs.select(F.struct(*kept).alias("row"), F.col(text_col).cast("binary").alias("text"))
    fields = rows.schema["row"].dataType.simpleString()
    schema = ALIGNED.format(row=fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = pair_of(tokenizers)
        vector = np.zeros(len(pair.a_bytes), np.int64)
        number = TaskContext.get().partitionId() << 32
        row_type = None

        def batch_of(n: int, **columns: pa.Array) -> pa.RecordBatch:
            types = {
                "chunk": pa.int64(), "row": row_type, "n_a": pa.int64(), "n_b": pa.int64(), "n_groups": pa.int64(), "n_links": pa.int64(),
                "groups": pa.string(), "own": pa.binary(), "own_n": pa.binary(), "odd": pa.binary(), "odd_n": pa.binary(),
                "pairs": pa.binary(), "pair_docs": pa.binary(), "n_pairs": pa.int64(), "vector": pa.list_(pa.int32()),
            }
            arrays = [columns.get(name, None) for name in types]
            arrays = [pa.nulls(n, t) if x is None else x for x, t in zip(arrays, types.values())]
            return pa.RecordBatch.from_arrays(arrays, names=list(types))

        for batch in batches:
            row_type, size = batch.column("row").type, 0
            texts: list[bytes | None] = []
            for at, text in enumerate(batch.column("text")):
                texts.append(text.as_py())
                size += len(texts[-1] or b"")
                if size < CHUNK_BYTES and at + 1 < batch.num_rows:
                    continue
                chunk = Chunk(texts, pair)
                written = chunk.written(pair)
                groups = (hashlib.sha256(x).hexdigest() if digest and x else x.decode() for x in written)
                own, odd = chunk.regular, ~chunk.regular
                a = (chunk.pairs >> BITS).astype("<u2")
                vector += np.bincount(a[own], minlength=len(vector))
                yield batch_of(
                    len(texts),
                    chunk=pa.array(np.full(len(texts), number)),
                    row=batch.column("row").slice(at + 1 - len(texts), len(texts)),
                    groups=pa.array(groups, pa.string()),
                    **{c: pa.array(getattr(chunk, c)) for c in ("n_a", "n_b", "n_groups", "n_links")},
                    own=pa.array(chunk.by_text(own, a), pa.binary()),
                    own_n=pa.array(chunk.by_text(own, chunk.times.astype("<u4")), pa.binary()),
                    odd=pa.array(chunk.by_text(odd, chunk.pairs.astype("<u4")), pa.binary()),
                    odd_n=pa.array(chunk.by_text(odd, chunk.times.astype("<u4")), pa.binary()),
                )
                pairs, n = np.unique(chunk.pairs[odd].astype("<u4"), return_counts=True)
                yield batch_of(
                    1,
                    chunk=pa.array([number]),
                    pairs=pa.array([pairs.tobytes()], pa.binary()),
                    pair_docs=pa.array([n.astype("<u4").tobytes()], pa.binary()),
                    n_pairs=pa.array([len(pairs)]),
                )
                number, texts, size = number + 1, [], 0
        if row_type is not None:
            yield batch_of(1, vector=pa.array([vector.astype(np.int32)], pa.list_(pa.int32())))

    return stage(rows.mapInArrow(run, schema), "aligned")


def split_pairs(pairs: np.ndarray, segments: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """An order of ``pairs`` by segment, the segments that have some, and where they start."""
    mixed = pairs.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(32)
    segment = (mixed * np.uint64(segments) >> np.uint64(32)).astype(np.int64)
    order = np.argsort(segment, kind="stable")
    found, first = np.unique(segment[order], return_index=True)
    return order, found, first


def _numbers(parts: pa.ChunkedArray, kind: str) -> list[np.ndarray]:
    return [np.frombuffer(part.as_buffer(), kind) for part in parts]


def irregular_totals(aligned: DataFrame) -> tuple[DataFrame, int]:
    """A written table with, for each chunk and segment, the ``totals`` of the pairs the
    chunk asked for there, and, for each segment, all its ``pairs`` and their ``totals``;
    and the number of segments."""
    chunks = aligned.filter("n_pairs is not null").select("chunk", "pairs", "pair_docs", "n_pairs")
    asked = chunks.agg(F.sum("n_pairs")).first()[0] or 0
    segments = asked // SEGMENT_PAIRS + 1

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, pairs, n in zip(batch.column("chunk"), *(_numbers(batch.column(c), "<u4") for c in ("pairs", "pair_docs"))):
                order, segment, first = split_pairs(pairs, segments)
                split = [[p.tobytes() for p in np.split(x[order], first[1:])][: len(segment)] for x in (pairs, n)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(segment), pa.array([chunk.as_py()] * len(segment), pa.int64()), *[pa.array(s, pa.binary()) for s in split]],
                    names=["segment", "chunk", "pairs", "pair_docs"],
                )

    def add_up(key: tuple, asks: pa.Table) -> pa.Table:
        parts = _numbers(asks["pairs"], "<u4")
        pairs, place = np.unique(np.concatenate(parts), return_inverse=True)
        total = np.bincount(place, np.concatenate(_numbers(asks["pair_docs"], "<u4"))).astype("<i8")
        answers = np.split(total[place], np.cumsum([len(p) for p in parts])[:-1])
        return pa.table(
            {
                "segment": pa.array([key[0].as_py()] * (len(parts) + 1), pa.int64()),
                "chunk": pa.array([*asks["chunk"].to_pylist(), None], pa.int64()),
                "totals": pa.array([x.tobytes() for x in (*answers, total)], pa.binary()),
                "pairs": pa.array([*[None] * len(parts), pairs.tobytes()], pa.binary()),
            }
        )

    dealt = chunks.mapInArrow(deal, "segment long, chunk long, pairs binary, pair_docs binary")
    summed = dealt.groupBy("segment").applyInArrow(add_up, "segment long, chunk long, totals binary, pairs binary")
    return stage(summed, "pair_totals"), segments


def regular_counts(aligned: DataFrame) -> DataFrame:
    """``a`` and ``n``: the documents that hold each regular pair."""
    vectors = aligned.filter("vector is not null").select(F.posexplode("vector").alias("a", "n"))
    return vectors.filter("n > 0").groupBy("a").agg(F.sum("n").alias("n"))


def _by_pair(totals: DataFrame, best_only: bool) -> DataFrame:
    """``a``, ``b`` and ``n`` of all irregular pairs, or the largest ``n`` of each ``a`` in a segment."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for pairs, n in zip(_numbers(batch.column("pairs"), "<u4"), _numbers(batch.column("totals"), "<i8")):
                a, b = (pairs >> 16).astype(np.int32), (pairs & 0xFFFF).astype(np.int32)
                if best_only and len(a):
                    first = np.flatnonzero(np.append(True, a[1:] != a[:-1]))
                    a, b, n = a[first], b[first], np.maximum.reduceat(n, first)
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(n)], names=["a", "b", "n"])

    return totals.filter("pairs is not null").select("pairs", "totals").mapInArrow(run, "a int, b int, n long")


def pair_counts(aligned: DataFrame, totals: DataFrame, tokenizers: dict | None = None) -> DataFrame:
    """``a``, ``b`` and ``n``: every linked pair and the number of documents that hold it."""
    tokenizers = tokenizers or tokenizer_files()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        same = pair_of(tokenizers).same
        for batch in batches:
            b = pa.array(same[batch.column("a").to_numpy()].astype(np.int32))
            yield pa.RecordBatch.from_arrays([batch.column("a"), b, batch.column("n")], names=["a", "b", "n"])

    return _by_pair(totals, False).union(regular_counts(aligned).mapInArrow(run, "a int, b int, n long"))


def scored_documents(aligned: DataFrame, totals: DataFrame, segments: int) -> DataFrame:
    """The columns kept of every document, its counts and ``groups``, ``n_best`` (links
    whose pair's count is the highest of its A identifier) and ``count_sum`` (counts of all links)."""
    spark = aligned.sparkSession
    regular = regular_counts(aligned)
    highest = _by_pair(totals, True).select("a", "n").union(regular.select("a", "n")).groupBy("a").agg(F.max("n").alias("n"))
    vectors = []
    for table in (regular, highest):  # at most as many rows as A has identifiers
        held = table.toPandas()
        vector = np.zeros(1 << 16, np.int64)
        vector[held["a"].to_numpy(np.int64)] = held["n"].to_numpy(np.int64)
        vectors.append(vector)
    sent = spark.sparkContext.broadcast(vectors)
    docs = aligned.filter("row is not null").select(
        "chunk", "row", "n_a", "n_b", "n_groups", "n_links", "groups", "own", "own_n", "odd", "odd_n"
    )
    answers = totals.filter("chunk is not null").select("chunk", "segment", "totals")
    kept = ["row", "n_a", "n_b", "n_groups", "n_links", "groups"]

    def run(texts: pa.Table, found: pa.Table) -> pa.Table:
        own_total, best = sent.value
        own, own_n, odd, odd_n = (
            np.concatenate([np.zeros(0, kind), *_numbers(texts[c], kind)]).astype(np.int64)
            for c, kind in (("own", "<u2"), ("own_n", "<u4"), ("odd", "<u4"), ("odd_n", "<u4"))
        )
        pairs, place = np.unique(odd, return_inverse=True)
        order, _, _ = split_pairs(pairs, segments)
        total = np.empty(len(pairs), np.int64)
        total[order] = np.concatenate([np.zeros(0, np.int64), *_numbers(found.sort_by("segment")["totals"], "<i8")])
        n_best, count_sum = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
        for lengths, times, n, top in (
            ([len(x.as_buffer()) // 2 for x in texts["own"]], own_n, own_total[own], best[own]),
            ([len(x.as_buffer()) // 4 for x in texts["odd"]], odd_n, total[place], best[odd >> 16]),
        ):
            ends = np.cumsum(np.array(lengths, np.int64))
            n_best += _sums(times * (n == top), ends)
            count_sum += _sums(times * n, ends)
        return pa.table([*[texts[c] for c in kept], pa.array(n_best), pa.array(count_sum)], names=[*kept, "n_best", "count_sum"])

    fields = docs.schema["row"].dataType.simpleString()
    schema = f"row {fields}, n_a long, n_b long, n_groups long, n_links long, groups string, n_best long, count_sum long"
    scored = docs.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(run, schema)
    return scored.select("row.*", *scored.columns[1:])


def alignment(
    docs: DataFrame, kept: list[str], text_col: str = "text", tokenizers: dict | None = None, digest: bool = False
) -> DataFrame:
    """``scored_documents`` of all ``docs``."""
    aligned = aligned_texts(docs, kept, text_col, tokenizers, digest)
    return scored_documents(aligned, *irregular_totals(aligned))
