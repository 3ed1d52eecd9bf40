"""Approximate nearest neighbours by randomly rotated one-bit codes.

Equal vectors are one class, with the ``k + 1`` smallest of their identifiers; no result
needs more.  Classes are dealt to cells, by the nearest of at most ``CENTRES`` centres,
which are fitted on a bounded sample of ``PER_CENTRE`` vectors a centre.  What a unit
vector has beside its centre is rotated at random into ``WIDEN`` times its length and
kept as the signs of its components, one bit each, with three scalars: its cosine with
the centre, the length of the rest, and the inner product of the rotated rest and its
own code.  A rotated query is rounded to ``PLANES`` bits a component.  Population counts of code and
query bits, divided by the last scalar, estimate the cosine, and the scalars also give the
width of its error bound (``BOUND`` standard deviations).

A query first asks its ``HOME`` nearest cells for their best estimates; the exact cosines of
these say what a candidate has to reach.  Then it asks the nearest cells that can hold such a
candidate by the triangle inequality.  How many of the nearest is measured: ``TRIALS`` queries of each length,
chosen by hash, ask all cells, and ``SHARE`` of their results have to be in the cells asked.
Vectors without structure need almost all cells, then, and clustered ones few.  Candidates whose upper bounds reach
the floor are joined with their vectors and ranked by exact cosines.  Only codes, scalars and
numbers go to the blocks, which are parts of cells with parts of their queries; vectors go
to the candidates that are ranked.  No bound is a cap: candidates that reach the floor are all ranked.

Defined cases: vectors that are null, empty or zero, or hold components that are
null or not finite, and rows without identifier take no part; rows equal in identifier
and vector are one row; different vectors with one identifier are rows of their own, each a
candidate for the others, and each a query with ranks of its own; vectors are brought near
one by powers of two before they are squared, so no finite component is too large or small;
vectors are compared with those of the same length only, and lengths beyond the ``LENGTHS``
commonest, or with few vectors, have one cell; ties go to the smaller identifier; an empty table gives an empty
result; further columns do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stage, worker_value

SEED, WIDEN, PLANES, BOUND, TRIALS, SHARE = 7, 4, 4, 2.5, 256, 0.99
CELL, CENTRES, PER_CENTRE, VALUES, LENGTHS, ROUNDS, HOME = 8192, 1024, 32, 1 << 18, 16, 5, 4
CANDIDATES, QUERIES, PART, SALTS = 32768, 2048, 32, 8

CODES = "row long, size int, cell int, code binary, along double, rest double, scalar double"
ASKED = "q long, size int, cell int, nth int, cosine double, floor double, bits binary, low double, step double, total double"


def rotation(size: int) -> np.ndarray:
    """``size`` orthogonal rows of a whole number of 64-bit words, the same everywhere."""

    def make() -> np.ndarray:
        bits = -(-size * WIDEN // 64) * 64
        q, r = np.linalg.qr(np.random.default_rng(SEED).standard_normal((bits, size)))
        return (q * np.sign(np.diag(r))).T

    return worker_value(("rotation", size), make)


def scaled(vectors: np.ndarray) -> np.ndarray:
    """The vectors times powers of two that bring their largest components near one: no
    digit changes, and no square overflows or vanishes."""
    return np.ldexp(vectors, -np.frexp(np.abs(vectors).max(axis=1, keepdims=True, initial=0))[1])


def unit(vectors: np.ndarray) -> np.ndarray:
    vectors = scaled(vectors)
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def exact_cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosines of the rows of two tables, in double precision."""
    a, b = scaled(a), scaled(b)
    return (a * b).sum(axis=1) / (np.sqrt((a * a).sum(axis=1)) * np.sqrt((b * b).sum(axis=1)))


def fit_centres(sample: np.ndarray, count: int) -> np.ndarray:
    """Unit centres of a sample of vectors."""
    points = unit(sample)
    centres = points[:count].copy()
    for _ in range(ROUNDS):
        sums = np.zeros_like(centres)
        np.add.at(sums, np.argmax(points @ centres.T, axis=1), points)
        lengths = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(lengths > 1e-9, sums / np.maximum(lengths, 1e-9), centres)
    return centres


def encode(vectors: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, ...]:
    """Cells, sign bits in words, cosines with the centres, lengths of the rests, and the
    inner products of the rests' directions with their codes."""
    points = unit(vectors)
    cosines = points @ centres.T
    cell = np.argmax(cosines, axis=1)
    along = cosines[np.arange(len(cell)), cell]
    rest = points - along[:, None] * centres[cell]
    length = np.linalg.norm(rest, axis=1)
    rotated = (rest / np.maximum(length, 1e-12)[:, None]) @ rotation(points.shape[1])
    scalar = np.abs(rotated).sum(axis=1) / np.sqrt(rotated.shape[1])
    words = np.packbits(rotated > 0, axis=1).view(np.uint64)
    return cell, words, along, length, np.where(length > 1e-9, scalar, 1.0)


def planes(queries: np.ndarray) -> tuple[np.ndarray, ...]:
    """Rotated unit queries rounded to ``PLANES`` bits a component, as words by query and
    plane, with the least value, the step and the sum of the components."""
    rotated = unit(queries) @ rotation(queries.shape[1])
    low = rotated.min(axis=1)
    step = (rotated.max(axis=1) - low) / (2**PLANES - 1)
    step = np.where(step > 0, step, 1.0)
    level = np.rint((rotated - low[:, None]) / step[:, None]).astype(np.uint8)
    bits = np.stack([np.packbits(level >> j & 1, axis=1) for j in range(PLANES)], axis=1)
    return bits.view(np.uint64), low, step, rotated.sum(axis=1)


def estimate(
    bits: np.ndarray, low: np.ndarray, step: np.ndarray, total: np.ndarray, cosine: np.ndarray,
    words: np.ndarray, along: np.ndarray, rest: np.ndarray, scalar: np.ndarray,
) -> tuple[np.ndarray, np.ndarray]:
    """Estimated cosines of queries (first line) and coded vectors (second) of one cell,
    and the widths of their error bounds."""
    size = words.shape[1] * 64
    whole = np.uint16 if size << PLANES < 1 << 16 else np.uint32
    level = np.zeros((len(bits), len(words)), whole)
    for j in reversed(range(PLANES)):
        level <<= 1
        for column, asked in zip(np.ascontiguousarray(words.T), bits[:, j].T):
            level += np.bitwise_count(column & asked[:, None])
    held = np.bitwise_count(words).sum(axis=1, dtype=np.int64)
    inner = 2 * (low[:, None] * held + step[:, None] * level) - total[:, None]
    factor = rest / scalar
    code_error = np.sqrt(np.maximum(0, 1 - scalar**2) / max(1, size - 1))
    width = BOUND * factor * (code_error + step[:, None] / np.sqrt(6))
    return cosine[:, None] * along + inner * (factor / np.sqrt(size)), width + 1e-6


def reach(cosine: np.ndarray, least: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Upper bounds of cosines of queries with the vectors of cells, from the queries'
    cosines with the centres and the least and largest cosines of the vectors with them."""
    across = np.sqrt(np.maximum(0, 1 - cosine**2))

    def at(along: np.ndarray) -> np.ndarray:
        return along * cosine + np.sqrt(np.maximum(0, 1 - along**2)) * across

    return at(np.clip(cosine, least, most)) + 1e-6


def _valid(vector: Column) -> Column:
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    some = F.exists(vector, lambda x: x != 0)
    return vector.isNotNull() & fine & some


def _matrix(column) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(column.flatten().to_numpy(zero_copy_only=False), np.float64).reshape(len(column), -1)


def _words(column, *shape: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint64).reshape(len(column), *shape)


def _by_size(run, schema: str, most: int = 1024):
    """A function of record batches that calls ``run(size, at most ``most`` rows of that size)``."""
    names = [part.split()[0] for part in schema.split(", ")]

    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            sizes = batch.column("size").to_numpy()
            for size in np.unique(sizes):
                rows = batch.filter(pa.array(sizes == size))
                for low in range(0, len(rows), most):
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in run(int(size), rows.slice(low, most))], names=names)

    return batches


def _packed(words: np.ndarray) -> pa.Array:
    return pa.array([w.tobytes() for w in words], pa.binary())


def centres_of(vectors: DataFrame) -> dict[int, np.ndarray]:
    """Centres by length: at most ``LENGTHS`` lengths of at most ``VALUES`` numbers."""
    found = {}
    sizes = vectors.groupBy("size").count().filter(F.col("count") >= 2 * CELL).orderBy(F.desc("count"), "size").limit(LENGTHS)
    for size, n in sizes.collect():
        count = max(1, min(CENTRES, n // CELL, VALUES // size))
        key = F.xxhash64("vector")
        some = vectors.filter((F.col("size") == size) & (F.pmod(key, F.lit(n)) < 2 * PER_CENTRE * count))
        sample = some.select("vector").orderBy(key, "vector").limit(PER_CENTRE * count).collect()
        if len(sample) >= count:
            found[size] = fit_centres(np.array([r["vector"] for r in sample]), count)
    return found


def index(rows: DataFrame, keep: int) -> tuple[DataFrame, DataFrame, dict[int, np.ndarray]]:
    """Classes of equal vectors (``row``, ``size``, ``vector``, and ``ids``, the ``keep`` smallest
    identifiers), their codes, and the centres by length.  Every vector is coded."""
    nth = F.row_number().over(Window.partitionBy("vector").orderBy("id"))
    classes = rows.withColumn("nth", nth).filter(F.col("nth") <= keep).groupBy("vector").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    classes = stage(classes.select(F.monotonically_increasing_id().alias("row"), F.size("vector").alias("size"), "vector", "ids"), "vectors")
    centres = centres_of(classes)

    def run(size: int, part: pa.RecordBatch) -> list:
        cell, words, *scalars = encode(_matrix(part.column("vector")), centres.get(size, np.zeros((1, size))))
        return [part.column("row"), part.column("size"), cell.astype(np.int32), _packed(words), *scalars]

    return classes, stage(classes.select("row", "size", "vector").mapInArrow(_by_size(run, CODES), CODES), "codes"), centres


def _ask(asked: DataFrame, centres: dict[int, np.ndarray], bounds: dict[tuple[int, int], tuple[float, float]], probes: dict[int, int]) -> DataFrame:
    """Queries with the cells they ask, by nearness of the centre from 0 (``nth``): of the first
    ``probes`` of their length (or of all) those within reach of ``floor``, if there is one."""

    def run(size: int, part: pa.RecordBatch) -> list:
        queries = _matrix(part.column("vector"))
        cosines = unit(queries) @ centres.get(size, np.zeros((1, size))).T
        floor = part.column("floor").to_numpy(zero_copy_only=False).astype(float)
        span = np.array([bounds.get((size, c), (-1.0, 1.0)) for c in range(cosines.shape[1])])
        nth = np.argsort(np.argsort(-cosines, axis=1, kind="stable"), axis=1)
        within = np.isnan(floor)[:, None] | (reach(cosines, span[:, 0], span[:, 1]) >= floor[:, None])
        q, cell = np.nonzero(within & (nth < probes.get(size, nth.shape[1])))
        bits, low, step, total = planes(queries)
        packed = _packed(bits).take(pa.array(q))
        ids = part.column("q").take(pa.array(q))
        return [ids, np.full(len(q), size, np.int32), cell.astype(np.int32), nth[q, cell].astype(np.int32), cosines[q, cell], floor[q], packed, low[q], step[q], total[q]]

    return asked.select("q", "size", "vector", "floor").mapInArrow(_by_size(run, ASKED, 128), ASKED)


def _scan(codes: DataFrame, cells: DataFrame, asking: DataFrame, few: int) -> DataFrame:
    """``q`` and ``row`` of the candidates in the asked cells: those whose upper bound reaches
    the floor, or the ``few`` best estimates of each block for queries without one."""
    wanted = asking.groupBy("size", "cell").agg(F.ceil(F.count(F.lit(1)) / QUERIES).cast("int").alias("groups"))
    blocks = cells.join(wanted, ["size", "cell"]).select("size", "cell", F.ceil(F.col("n") / CANDIDATES).cast("int").alias("parts"), "groups")

    def one(n: str, key: str) -> Column:
        return F.pmod(F.xxhash64(key, F.lit(1)), F.col(n)).cast("int")

    def every(n: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    left = codes.join(blocks, ["size", "cell"]).withColumn("part", one("parts", "row")).withColumn("part_of", every("groups")).drop("parts", "groups")
    right = asking.join(blocks, ["size", "cell"]).withColumn("part_of", one("groups", "q")).withColumn("part", every("parts")).drop("parts", "groups")
    schema = pa.schema([("q", pa.int64()), ("row", pa.int64())])

    def search(candidates: pa.Table, queries: pa.Table) -> pa.Table:
        if not len(candidates) or not len(queries):
            return schema.empty_table()
        words = _words(candidates["code"], -1)
        scalars = [candidates[c].to_numpy() for c in ("along", "rest", "scalar")]
        asked, rows, found = queries["q"].to_numpy(), candidates["row"].to_numpy(), []
        for low in range(0, len(queries), PART):
            part = queries.slice(low, PART)
            numbers = [part[c].to_numpy() for c in ("low", "step", "total", "cosine")]
            floor = part["floor"].to_numpy()
            cosines, width = estimate(_words(part["bits"], PLANES, words.shape[1]), *numbers, words, *scalars)
            q, c = np.nonzero(cosines + width >= floor[:, None])
            found.append((asked[low + q], rows[c]))
            first = np.flatnonzero(np.isnan(floor))
            n = min(few, len(rows))
            best = np.argpartition(-cosines[first], n - 1, axis=1)[:, :n]
            found.append((np.repeat(asked[low + first], n), rows[best.ravel()]))
        return pa.table([pa.array(np.concatenate(x)) for x in zip(*found)], schema=schema)

    keys = ["size", "cell", "part", "part_of"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(search, "q long, row long")


def _ranked(pairs: DataFrame, classes: DataFrame, asked: DataFrame) -> DataFrame:
    """``q``, ``row``, exact ``score``, ``same`` (equal vectors) and ``ids`` of pairs."""
    both = pairs.join(classes.select("row", "vector", "ids"), "row").join(asked.select("q", F.col("vector").alias("query")), "q")
    schema = "q long, row long, score double, same boolean, ids array<long>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.diff(batch.column("query").offsets.to_numpy())
            for size in np.unique(sizes):
                part = batch.filter(pa.array(sizes == size))
                a, b = _matrix(part.column("query")), _matrix(part.column("vector"))
                columns = [part.column("q"), part.column("row"), pa.array(exact_cosines(a, b)), pa.array((a == b).all(axis=1)), part.column("ids")]
                yield pa.RecordBatch.from_arrays(columns, names=["q", "row", "score", "same", "ids"])

    return both.select("q", "row", "query", "vector", "ids").mapInArrow(run, schema)


def nearest(
    vectors: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id`` and ``score`` of the ``k`` nearest vectors of
    each query, a vector whose ``id`` fulfils ``is_query``."""
    rows = (
        vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("vector"))
        .filter(F.col("id").isNotNull() & _valid(F.col("vector")))
        .distinct()
    )
    # one result more: a query is among its own candidates
    most = k + 1
    classes, codes, centres = index(rows, most)
    cells = codes.groupBy("size", "cell").agg(F.count(F.lit(1)).alias("n"), F.min("along").alias("least"), F.max("along").alias("most"))
    # one row a centre, and their number has a bound
    known = cells.filter(F.col("size").isin(list(centres))).collect() if centres else []
    bounds = {(r["size"], r["cell"]): (r["least"], r["most"]) for r in known}

    queries = rows.filter(is_query)
    asked = queries.select("vector").distinct().select(F.monotonically_increasing_id().alias("q"), F.size("vector").alias("size"), "vector")
    asked = stage(asked, "asked")
    first = _ask(asked.withColumn("floor", F.lit(None).cast("double")), centres, bounds, {size: HOME for size in centres})
    # a row of few results has no floor and asks for everything of its length
    nth = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score")))
    reached = _ranked(_scan(codes, cells, first, 4 * most), classes, asked).select("q", "score").withColumn("nth", nth)
    floors = reached.filter(F.col("nth") == most).select("q", (F.col("score") - 1e-6).alias("floor"))
    again = stage(asked.join(floors, "q", "left").withColumn("floor", F.coalesce("floor", F.lit(-2.0))), "floors")
    probes = {}
    if centres:
        nth = F.row_number().over(Window.partitionBy("size").orderBy(F.xxhash64("vector"), "vector"))
        trials = again.filter(F.col("size").isin(list(centres))).withColumn("nth", nth).filter(F.col("nth") <= TRIALS)
        asking = _ask(trials, centres, bounds, {})
        nth = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "row"))
        near = _ranked(_scan(codes, cells, asking, 0), classes, asked).filter(~F.col("same")).withColumn("at", nth).filter(F.col("at") <= k)
        places = near.select("q", "row").join(codes.select("row", "size", "cell"), "row").join(asking.select("q", "cell", "nth"), ["q", "cell"])
        # one number a length
        measured = places.groupBy("size").agg(F.percentile("nth", F.lit(SHARE)).alias("nth")).collect()
        probes = {r["size"]: max(HOME, int(np.ceil(r["nth"])) + 1) for r in measured}
    asking = stage(_ask(again, centres, bounds, probes), "asking")

    found = _ranked(_scan(codes, cells, asking, 0), classes, asked).select("q", "score", "same", F.explode("ids").alias("id"))
    best = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "id"))
    found = found.withColumn("nth", best).filter(F.col("nth") <= most)
    lists = found.groupBy("q").agg(F.sort_array(F.collect_list(F.struct("nth", "id", "score", "same"))).alias("near"))
    # many queries may share a vector: its list goes to several tasks
    lists = lists.join(asked, "q").select("vector", "near", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    salted = queries.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int"))
    others = F.filter("near", lambda x: ~(x["same"] & (x["id"] == F.col("id"))))
    result = salted.join(lists, ["vector", "salt"]).select(F.col("id").alias("query_id"), F.posexplode(F.slice(others, 1, k)).alias("at", "x"))
    return result.select("query_id", (F.col("at") + 1).alias("rank"), F.col("x.id").alias("vec_id"), F.col("x.score").alias("score"))
