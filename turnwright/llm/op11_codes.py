"""Vectors as short codes: each of a few equal parts is told by the nearest of its codebook's entries, which Lloyd's rounds move to the means of their parts.

Rounds are pruned as Elkan's are. A part keeps an upper bound of the distance to its entry and a lower bound for every entry of its codebook; when entries move, bounds are
shifted by as much, and an entry is left out only if its lower bound, or half its distance to the part's own entry, is strictly greater than the upper bound. What is left
is decided by integers, ties by the lower index, so results are those of the unpruned method, whatever the bounds. Bounds are written with the vectors after each round, as Parquet in the
shared folder, lower ones in sixteen steps between the least and the greatest of a part, always rounded down; the round before is then deleted. Entries, and sums of the parts
of each, are bounded by the codebooks' size; sums are made within tasks before they are shuffled.

Defined results: vectors that are null, or hold null or non-finite components, are dropped, and so are those of another length than most (of equally frequent
lengths the greater counts), as they have no such parts. A length that doesn't divide into the parts is filled up with zeros. Components beyond what exact sums in 64 bits allow
(2^28 for parts of 16) are drawn to that bound. Rows with a null id are coded, and begin no codebook while 256 others are there; rows of an id that repeats are told apart by
their components. Fewer vectors than entries make fewer entries. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from turnwright.llm.clusterio import discard, kept, scratch, table

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
ROWS = 4096
LEVELS = 15
#: Bounds are computed in floating point; so much is added to upper and taken from lower ones, relative to what they are.
_SLACK = 1e-6


def square_distances(x: np.ndarray, book: np.ndarray) -> np.ndarray:
    """Of every part to every entry, exact: in floating point where all sums are below 2^53, else in 64-bit integers."""
    most = int(max(np.abs(x).max(initial=0), np.abs(book).max(initial=0)))
    kind = np.float64 if x.shape[1] * 4 * most * most < 1 << 53 else np.int64
    x, book = x.astype(kind), book.astype(kind)
    return ((x * x).sum(axis=1)[:, None] - 2 * (x @ book.T) + (book * book).sum(axis=1)).astype(np.int64)


def pair_distances(x: np.ndarray, book: np.ndarray, row: np.ndarray, entry: np.ndarray) -> np.ndarray:
    """Of given parts to given entries, in integers."""
    out = np.empty(len(row), np.int64)
    for k in range(0, len(row), 1 << 16):
        gap = x[row[k : k + (1 << 16)]] - book[entry[k : k + (1 << 16)]]
        out[k : k + (1 << 16)] = np.einsum("ij,ij->i", gap, gap)
    return out


def _over(square: np.ndarray) -> np.ndarray:
    return np.sqrt(square.astype(np.float64)) * (1 + _SLACK)


def _under(square: np.ndarray) -> np.ndarray:
    return np.sqrt(square.astype(np.float64)) * (1 - _SLACK)


class Book:
    """One part's entries, how far each has moved at most since bounds were written, and half the distances between them at least."""

    def __init__(self, entries: np.ndarray, before: np.ndarray | None = None):
        self.entries = entries
        gap = entries - (entries if before is None else before)
        self.moved = _over(np.einsum("ij,ij->i", gap, gap))
        self.half = _under(square_distances(entries, entries)) / 2


def first(x: np.ndarray, book: Book) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each part's entry, its upper bound and its lower bounds, from all distances."""
    square = square_distances(x, book.entries)
    own = square.argmin(axis=1)
    return own, _over(square[np.arange(len(x)), own]), _under(square)


def again(x: np.ndarray, book: Book, own: np.ndarray, upper: np.ndarray, lower: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """The same from the bounds of the round before; and how many distances it took."""
    upper = (upper + book.moved[own]) * (1 + _SLACK)
    lower = np.maximum(lower - book.moved, 0) * (1 - _SLACK)
    every = np.arange(len(book.entries))

    def open_to(rows: np.ndarray) -> np.ndarray:
        most = upper[rows, None]
        return (lower[rows] <= most) & (book.half[own[rows]] <= most) & (every != own[rows, None])

    rows = np.flatnonzero(open_to(np.arange(len(x))).any(axis=1))
    exact = pair_distances(x, book.entries, rows, own[rows])
    upper[rows] = _over(exact)
    lower[rows, own[rows]] = _under(exact)
    at, entry = np.nonzero(open_to(rows))  # by row, then by entry
    square = pair_distances(x, book.entries, rows[at], entry)
    lower[rows[at], entry] = _under(square)
    if len(at):
        begin = np.flatnonzero(np.diff(at, prepend=-1))
        least = np.minimum.reduceat(square, begin)
        lowest = np.minimum.reduceat(np.where(square == np.repeat(least, np.diff(np.append(begin, len(at)))), entry, len(book.entries)), begin)
        of = at[begin]
        better = (least < exact[of]) | ((least == exact[of]) & (lowest < own[rows[of]]))
        own = own.copy()
        own[rows[of[better]]] = lowest[better]
        upper[rows[of[better]]] = _over(least[better])
    return own, upper, lower, len(rows) + len(at)


def pack(upper: np.ndarray, lower: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bounds of parts as bytes: upper, least and greatest lower bound; and lower bounds in steps between these, two a byte."""
    least, most = lower.min(axis=1), lower.max(axis=1)
    ends = np.stack([np.nextafter(upper.astype(np.float32), np.float32(np.inf)), np.nextafter(least.astype(np.float32), np.float32(0)), np.nextafter(most.astype(np.float32), np.float32(0))], axis=1)
    low, step = ends[:, 1:2].astype(np.float64), ((ends[:, 2] - ends[:, 1]) / LEVELS).astype(np.float64)[:, None]
    levels = np.clip(np.floor((lower - low) / np.where(step > 0, step, 1) * (1 - _SLACK)), 0, LEVELS).astype(np.uint8)
    levels = np.pad(levels, ((0, 0), (0, levels.shape[1] % 2)))
    return ends, levels[:, ::2] << 4 | levels[:, 1::2]


def unpack(ends: np.ndarray, levels: np.ndarray, entries: int) -> tuple[np.ndarray, np.ndarray]:
    upper, low = ends[:, 0].astype(np.float64), ends[:, 1:2].astype(np.float64)
    step = ((ends[:, 2] - ends[:, 1]) / LEVELS).astype(np.float64)[:, None]
    each = np.stack([levels >> 4, levels & 15], axis=2).reshape(len(levels), -1)[:, :entries]
    return upper, np.maximum(low + step * each, 0) * (1 - _SLACK)


def _binary(rows: np.ndarray) -> pa.Array:
    """Each row's bytes."""
    rows = np.ascontiguousarray(rows)
    width = rows.nbytes // max(len(rows), 1)
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer((np.arange(len(rows) + 1) * width).astype(np.int32).tobytes()), pa.py_buffer(rows.tobytes())])


def _array(column: pa.Array, kind: type, *shape: int) -> np.ndarray:
    """The rows of a binary column of equal widths."""
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(column.buffers()[2] or b"", kind, (offsets[-1] - offsets[0]) // np.dtype(kind).itemsize, int(offsets[0])).reshape(len(column), *shape)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for k in range(0, batch.num_rows, ROWS):
            yield batch.slice(k, ROWS)


_STATE = "vec_id long, label int, vector binary, own binary, ends binary, levels binary"


def _state(ids: list[pa.Array], x: np.ndarray, found: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    packed = [pack(upper, lower) for _, upper, lower in found]
    columns = [x.astype(np.int32), np.stack([own for own, *_ in found], axis=1).astype(np.uint8), np.stack([e for e, _ in packed], axis=1), np.stack([v for _, v in packed], axis=1)]
    return pa.RecordBatch.from_arrays([*ids, *map(_binary, columns)], names=["vec_id", "label", "vector", "own", "ends", "levels"])


def begin(vectors: DataFrame, books: list[Book], width: int) -> DataFrame:
    """The first round's state of rows of vec_id, label and vector (an array of int)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _pieces(batches):
            x = part.column(2).flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, width * len(books)).astype(np.int64)
            yield _state([part.column(0), part.column(1)], x, [first(x[:, k * width : (k + 1) * width], b) for k, b in enumerate(books)])

    return vectors.mapInArrow(run, _STATE)


def _advanced(part: pa.RecordBatch, books: list[Book], width: int) -> tuple[np.ndarray, list]:
    x = _array(part.column(2), np.int32, width * len(books)).astype(np.int64)
    own = _array(part.column(3), np.uint8, len(books)).astype(np.int64)
    ends, levels = _array(part.column(4), np.float32, len(books), 3), _array(part.column(5), np.uint8, len(books), (len(books[0].entries) + 1) // 2)
    return x, [again(x[:, k * width : (k + 1) * width], b, own[:, k], *unpack(ends[:, k], levels[:, k], len(b.entries)))[:3] for k, b in enumerate(books)]


def advance(state: DataFrame, books: list[Book], width: int) -> DataFrame:
    """The next round's state."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _pieces(batches):
            yield _state([part.column(0), part.column(1)], *_advanced(part, books, width))

    return state.mapInArrow(run, _STATE)


def finish(state: DataFrame, books: list[Book], width: int) -> DataFrame:
    """vec_id, label, code and error of each vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _pieces(batches):
            x, found = _advanced(part, books, width)
            rows, error = np.arange(len(x)), np.zeros(len(x), np.int64)
            for k, (own, *_) in enumerate(found):
                error += pair_distances(x[:, k * width : (k + 1) * width], books[k].entries, rows, own)
            hexed = np.stack([own for own, *_ in found], axis=1).astype(np.uint8).tobytes().hex()
            code = [hexed[k : k + 2 * len(books)] for k in range(0, len(hexed), 2 * len(books))]
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(code, pa.string()), pa.array(error)], names=["vec_id", "label", "code", "error"])

    return state.mapInArrow(run, "vec_id long, label int, code string, error long")


def means(state: DataFrame, books: list[Book], width: int) -> list[np.ndarray]:
    """Each codebook's entries moved to the floors of the means of their parts; entries of none stay."""
    parts, entries = len(books), len(books[0].entries)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, total = np.zeros((parts, entries), np.int64), np.zeros((parts, entries, width), np.int64)
        for part in _pieces(batches):
            x, own = _array(part.column(0), np.int32, parts, width), _array(part.column(1), np.uint8, parts)
            for k in range(parts):
                count[k] += np.bincount(own[:, k], minlength=entries)
                order = np.argsort(own[:, k], kind="stable")
                at, begin = np.unique(own[order, k], return_index=True)
                if width:
                    total[k, at] += np.add.reduceat(x[order, k].astype(np.int64), begin, axis=0)
        part, entry = np.nonzero(count)
        if len(part):
            sums = pa.FixedSizeListArray.from_arrays(pa.array(total[part, entry].ravel()), width).cast(pa.list_(pa.int64())) if width else pa.array([[]] * len(part), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(part.astype(np.int32)), pa.array(entry.astype(np.int32)), pa.array(count[part, entry]), sums], names=["part", "entry", "n", "total"])

    sums = state.select("vector", "own").mapInArrow(run, "part int, entry int, n long, total array<long>")
    rows = sums.groupBy("part", "entry").agg(F.sum("n").alias("n"), F.array(*(F.sum(F.col("total")[i]) for i in range(width))).alias("total")).collect()
    out = [b.entries.copy() for b in books]
    for r in rows:
        out[r.part][r.entry] = [t // r.n for t in r.total]
    return out


def integers(embeddings: DataFrame) -> tuple[DataFrame, int]:
    """vec_id, label and vector (whole numbers, filled up to whole parts) of the rows that count; and a part's width."""
    x = F.col("embedding").cast("array<double>")
    finite = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("int").alias("label"), x.alias("x")).where(F.col("x").isNotNull() & F.forall("x", lambda v: v.isNotNull() & (F.abs(v) < float("inf"))))
    usual = finite.groupBy(F.size("x").alias("length")).count().orderBy(F.desc("count"), F.desc("length")).first()
    length = usual.length if usual else 0
    width = -(-length // PARTS)
    most = min(isqrt((1 << 62) // (4 * max(width, 1))), (1 << 31) - 1)
    whole = F.transform("x", lambda v: F.greatest(F.least(F.floor(v * SCALE), F.lit(most)), F.lit(-most)).cast("int"))
    filled = F.concat(whole, F.array_repeat(F.lit(0), width * PARTS - length)) if length < width * PARTS else whole
    return finite.where(F.size("x") == length).select("vec_id", "label", filled.alias("vector")), width


def codes(embeddings: DataFrame) -> tuple[DataFrame, list[np.ndarray]]:
    """vec_id, label, code and error of the vectors that count, as a table in the shared folder; and the codebooks."""
    spark, folder = embeddings.sparkSession, scratch(embeddings.sparkSession)
    vectors, width = integers(embeddings)
    start = vectors.orderBy(F.asc_nulls_last("vec_id"), "vector").limit(ENTRIES).collect()
    entries = np.array([r.vector for r in start], np.int64).reshape(len(start), PARTS, width)
    if not len(start):
        return vectors.selectExpr("vec_id", "label", "'' AS code", "0L AS error").limit(0), []
    books = [Book(entries[:, k].copy()) for k in range(PARTS)]
    state = kept(begin(vectors, books, width), f"{folder}/0")
    for k in range(1, ROUNDS + 1):
        books = [Book(new, b.entries) for new, b in zip(means(state, books, width), books, strict=True)]
        state = kept(advance(state, books, width) if k < ROUNDS else finish(state, books, width), f"{folder}/{k}")
        discard(spark, f"{folder}/{k - 1}")
    return state, [b.entries for b in books]


def digest(books: list[np.ndarray]) -> str:
    """Of all entries' components in decimal, by part, entry and place."""
    return hashlib.sha256(",".join(str(v) for b in books for v in b.ravel().tolist()).encode()).hexdigest()


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector's code and error, and the error summed over its label."""
    coded, books = codes(table(spark, sf_dir, "embeddings"))
    by_label = kept(coded.groupBy("label").agg(F.sum("error").alias("label_error")), scratch(spark)).withColumnRenamed("label", "__label")
    both = coded.join(by_label, F.col("label").eqNullSafe(F.col("__label")))
    return both.select("vec_id", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))
