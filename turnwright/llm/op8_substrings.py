"""Substring dedup: super-k-mer partitioning of word windows, which are then sorted bucket by bucket.

A window is WINDOW consecutive words of a document. Its minimiser is the least hash of the MER-word runs in it. Consecutive
windows with one minimiser travel as one packed string to the minimiser's bucket, where the windows are sorted by their words (as two
unrelated 64-bit hashes of them), document and start; all but the first of equal windows start later than another one, and their words go.

Before windows travel, those of a few megabytes of input are sorted likewise, so of equal windows only the first is sent: a passage
in a third of all documents reaches its bucket once from each piece of input. Minimisers in very many packed strings all the same
(a line that all kinds of text surround) are found by a first pass, in a table of bounded size, and their windows are dealt by their
own hash instead. The number of buckets follows the input's size; whatever makes a bucket larger all the same, a task holds at most HELD
bytes of it at once, and what is over is dealt again by the windows' own hashes.

Defined results: a null or empty text has no words; rows with one doc_id are one document whose windows are told apart by their start,
so equal rows stay as they are and equal windows at equal starts are both kept; a row without doc_id counts as last; texts of fewer than
WINDOW words have no window; other columns pass through whatever their names, but for n_words, n_removed and kept_text, which are replaced.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from turnwright.llm.clusterio import cut, table
from turnwright.llm.words import Words, gather, mix, ngrams, slices, words

WINDOW, MER = 20, 3
#: Bytes of text for each bucket; packed strings of a minimiser in a piece of input to report it; in all, to deal its windows by themselves; such minimisers.
BUCKET, REPORT, HOT, TABLE = 4 << 20, 4, 20_000, 1 << 16
#: Packed bytes of a bucket that a task holds; bytes from which a packed string is worth compressing by itself.
HELD, SMALL = 6 << 20, 400
#: Marks of documents that lose words; others, told by a broadcast bit for each mark, aren't shuffled.
MARKS, MARK_ROW = 1 << 26, 1 << 16
LAST = np.iinfo(np.int64).max


def repeats(first: np.ndarray, second: np.ndarray, doc: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Which windows (by two hashes) equal one of a smaller document, or of the same and an earlier start."""
    out = np.zeros(len(first), bool)
    order = np.argsort(first)
    same = first[order][1:] == first[order][:-1]
    often = np.zeros(len(first), bool)
    often[1:] = same
    often[:-1] |= same
    some = order[often]
    some = some[np.lexsort((start[some], doc[some], second[some], first[some]))]
    if len(some):
        new = np.ones(len(some), bool)
        new[1:] = (first[some][1:] != first[some][:-1]) | (second[some][1:] != second[some][:-1])
        lead = some[np.flatnonzero(new)[np.cumsum(new) - 1]]
        out[some] = (doc[some] != doc[lead]) | (start[some] != start[lead])
    return out


def windows(w: Words, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where windows start that lie in one row, and two hashes of each."""
    at = np.flatnonzero(w.row[: len(w.row) - size + 1] == w.row[size - 1 :]) if len(w.row) >= size else np.zeros(0, np.int64)
    return at, ngrams(w.hash, size)[at], ngrams(w.other, size)[at]


def minimisers(hashes: np.ndarray, size: int) -> np.ndarray:
    """The least hash of the runs of MER words of each window."""
    low, width, need = ngrams(hashes, MER), 1, size - MER + 1
    while width < need:
        step = min(width, need - width)
        low, width = np.minimum(low[: len(low) - step], low[step:]), width + step
    return low


def runs(key: np.ndarray, doc: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Where runs begin of neighbours with one key and document and rising starts; at last, the length."""
    new = np.ones(len(key) + 1, bool)
    new[1:-1] = (key[1:] != key[:-1]) | (doc[1:] != doc[:-1]) | (start[1:] != start[:-1] + 1)
    return np.flatnonzero(new)


class Piece:
    """The windows of some rows (doc_id, text_hash, text), those first seen here, and the runs they travel in."""

    def __init__(self, batch: pa.RecordBatch, hot: np.ndarray, size: int):
        self.words = w = words(batch.column(2), hashes=2)
        first_word = w.bounds()
        at, self.one, two = windows(w, size)
        self.row, self.start = w.row[at], at - first_word[w.row[at]]
        doc = batch.column(0).fill_null(LAST).to_numpy(zero_copy_only=False)
        self.doc, self.text = doc[self.row], batch.column(1).to_numpy(zero_copy_only=False)
        self.again = repeats(self.one, two, self.doc, self.start)
        new = ~self.again
        low = minimisers(w.hash, size)[at][new] if len(at) else np.zeros(0, np.uint64)
        self.alone = np.isin(low, hot)
        self.key = np.where(self.alone, self.one[new], low)
        self.at, self.new = at[new], new
        self.runs = runs(self.key, self.row[new], self.start[new])


def survey(docs: DataFrame, size: int) -> DataFrame:
    """(kind, key, n): of kind 0, bytes of text; of kind 1, packed strings of minimisers that have many in a piece of input."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = np.zeros(0, np.uint64)
        for part in slices(batches, "text", 4 << 20):
            piece = Piece(part, none, size)
            key, n = np.unique(piece.key[piece.runs[:-1]], return_counts=True)
            key, n = key[n >= REPORT], n[n >= REPORT]
            kinds = np.array([0] + [1] * len(n), np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(kinds), pa.array(np.append(np.uint64(0), key).astype(np.int64)), pa.array(np.append(len(piece.words.buf), n).astype(np.int64))], names=["kind", "key", "n"])

    return docs.mapInArrow(run, "kind int, key long, n long").groupBy("kind", "key").agg(F.sum("n").alias("n"))


def packed(docs: DataFrame, hot: np.ndarray, buckets: int, size: int) -> DataFrame:
    """(bucket, payload): the windows to sort; and, with payload null, ranges of windows that are already known to repeat."""
    shared = docs.sparkSession.sparkContext.broadcast(hot)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=3)
        for part in slices(batches, "text", 4 << 20):
            p = Piece(part, shared.value, size)
            yield ranges(p.doc[p.again], p.text[p.row[p.again]], p.start[p.again], buckets)
            begin, end = p.runs[:-1], p.runs[1:]
            if not len(begin):
                continue
            bucket = (p.key[begin] % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            begin, end, bucket = begin[order], end[order], bucket[order]
            doc, row, start = p.doc[p.new][begin], p.row[p.new][begin], p.start[p.new][begin]
            head, tail = p.words.start[p.at[begin]], p.words.end[p.at[end - 1] + size - 1]
            edges = np.flatnonzero(np.append(True, np.append(bucket[1:] != bucket[:-1], True)))
            out = []
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                text, _ = gather(p.words.buf, head[a:b], tail[a:b])
                columns = (np.array([b - a]), np.diff(doc[a:b], prepend=0), p.text[row[a:b]], start[a:b].astype(np.int32), (tail - head)[a:b].astype(np.int32))
                out.append(_squeezed(squeeze, [*(c.tobytes() for c in columns), text.tobytes()]))
            yield _dealt(bucket[edges[:-1]], out)

    return docs.mapInArrow(run, SCHEMA)


NAMES = ["bucket", "payload", "doc", "text_hash", "low", "high"]
SCHEMA = "bucket long, payload binary, doc long, text_hash long, low int, high int"


def _dealt(bucket: np.ndarray, payloads: list[bytes]) -> pa.RecordBatch:
    none = pa.nulls(len(payloads), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array(bucket), pa.array(payloads, pa.binary()), none, none, none.cast(pa.int32()), none.cast(pa.int32())], names=NAMES)


def _squeezed(squeeze: zstandard.ZstdCompressor, parts: list[bytes]) -> bytes:
    data = b"".join(parts)
    return b"z" + squeeze.compress(data) if len(data) >= SMALL else b"=" + data


def _spread(payload: bytes) -> bytes:
    return zstandard.decompress(payload[1:]) if payload[:1] == b"z" else payload[1:]


def ranges(doc: np.ndarray, text: np.ndarray, start: np.ndarray, buckets: int) -> pa.RecordBatch:
    """Rows of ranges of window starts in documents; windows come in any order."""
    order = np.lexsort((start, text, doc))
    doc, text, start = doc[order], text[order], start[order]
    at = runs(text, doc, start)
    a, b = at[:-1], at[1:] - 1
    bucket = (mix(doc[a].astype(np.uint64)) % np.uint64(buckets)).astype(np.int64)
    return pa.RecordBatch.from_arrays([pa.array(bucket), pa.nulls(len(a), pa.binary()), pa.array(doc[a].astype(np.int64)), pa.array(text[a].astype(np.int64)), pa.array(start[a].astype(np.int32)), pa.array(start[b].astype(np.int32))], names=NAMES)


def unpack(payloads: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array]:
    """Documents, text hashes, starts and texts of the packed strings."""
    found: list[list[np.ndarray]] = [[], [], [], [], []]
    for payload in payloads:
        data = _spread(payload)
        n = int(np.frombuffer(data, np.int64, 1)[0])
        at = 8
        for k, kind in enumerate((np.int64, np.int64, np.int32, np.int32)):
            found[k].append(np.frombuffer(data, kind, n, at))
            at += found[k][-1].nbytes
        found[0][-1] = np.cumsum(found[0][-1])
        found[4].append(np.frombuffer(data, np.uint8, -1, at))
    doc, text, start, size, data = (np.concatenate(x) for x in found)
    ends = np.concatenate([[0], np.cumsum(size, dtype=np.int64)])
    return doc, text, start, pa.Array.from_buffers(pa.large_string(), len(doc), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(data.tobytes())])


@dataclass
class Sorted:
    """Windows by two hashes, with document, text hash and start; again: those that equal an earlier one."""

    one: np.ndarray
    two: np.ndarray
    doc: np.ndarray
    text: np.ndarray
    start: np.ndarray
    again: np.ndarray

    @classmethod
    def of_strings(cls, payloads: list[bytes], size: int) -> Sorted:
        doc, text, start, strings = unpack(payloads)
        w = words(strings, hashes=2)
        at, one, two = windows(w, size)
        row = w.row[at]
        begin = start[row] + at - w.bounds()[row]
        return cls(one, two, doc[row], text[row], begin, repeats(one, two, doc[row], begin))

    @classmethod
    def of_windows(cls, payloads: list[bytes], size: int) -> Sorted:
        data = [np.frombuffer(_spread(p), np.int64).reshape(5, -1) for p in payloads]
        one, two, doc, text, start = np.concatenate(data, axis=1)
        return cls(one, two, doc, text, start, repeats(one, two, doc, start))

    def ranges(self, buckets: int) -> pa.RecordBatch:
        return ranges(self.doc[self.again], self.text[self.again], self.start[self.again], buckets)

    def packed(self, buckets: int) -> pa.RecordBatch:
        """The windows that are first here, dealt by their own hash."""
        new, squeeze = ~self.again, zstandard.ZstdCompressor(level=1)
        bucket = (mix(self.one[new].view(np.uint64)) % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        columns = np.stack([c[new][order].view(np.int64) if c.dtype == np.uint64 else c[new][order].astype(np.int64) for c in (self.one, self.two, self.doc, self.text, self.start)])
        edges = np.flatnonzero(np.append(True, np.append(np.diff(bucket[order]) > 0, True))) if len(order) else np.zeros(1, np.int64)
        return _dealt(bucket[order][edges[:-1]], [_squeezed(squeeze, [columns[:, a:b].tobytes()]) for a, b in zip(edges[:-1], edges[1:], strict=True)])


def sort_buckets(rows: DataFrame, buckets: int, size: int, unpacked: Callable[[list[bytes], int], Sorted], last: bool = False) -> DataFrame:
    """Rows of SCHEMA: ranges of windows that start earlier elsewhere; and, unless it is the last time, windows of buckets of over HELD bytes, dealt anew."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[bytes] = []
        current, many, over = None, 0, False

        def ended() -> Iterator[pa.RecordBatch]:
            if held:
                found = unpacked(held, size)
                yield found.ranges(buckets)
                if over:
                    yield found.packed(buckets)

        for batch in batches:
            known = batch.filter(pc.is_null(batch.column(1)))
            if known.num_rows:
                yield known
            batch = batch.filter(pc.is_valid(batch.column(1)))
            for bucket, payload in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                more = not last and bucket == current and many + len(payload.as_py()) > HELD
                if bucket != current or more:
                    over |= more
                    yield from ended()
                    held, current, many, over = [], bucket, 0, more
                held.append(payload.as_py())
                many += len(held[-1])
        yield from ended()

    return rows.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(run, SCHEMA)


def _marks(found: DataFrame) -> np.ndarray:
    """A bit for each of MARKS marks, as bytes: whether a document with it loses words."""

    def bits(key: tuple, group: pa.Table) -> pa.Table:
        own = np.zeros(MARK_ROW, np.uint8)
        own[group.column("at").to_numpy()] = 1
        return pa.table({"row": pa.array([key[0].as_py()], pa.int32()), "bits": [np.packbits(own).tobytes()]})

    mark = F.pmod(F.xxhash64("doc", "text_hash"), F.lit(MARKS))
    each = found.select(F.floor(mark / MARK_ROW).cast("int").alias("row"), (mark % MARK_ROW).cast("int").alias("at")).distinct()
    out = np.zeros((MARKS // MARK_ROW, MARK_ROW // 8), np.uint8)
    for r in each.groupBy("row").applyInArrow(bits, "row int, bits binary").toLocalIterator():  # MARKS / 8 bytes in all
        out[r.row] = np.frombuffer(r.bits, np.uint8)
    return out.ravel()


def remove_repeats(docs: DataFrame, text: str = "text", size: int = WINDOW) -> DataFrame:
    """docs with n_words, n_removed and kept_text: the words left, joined by one space."""
    own = docs.select("doc_id", F.xxhash64(text).alias("text_hash"), F.col(text).alias("text"))
    seen = cut(survey(own, size))
    total = seen.where("kind = 0").agg(F.sum("n")).first()[0] or 0
    buckets = max(1, -(-3 * total // BUCKET))
    levels = {r.level: r.n for r in seen.where(f"kind = 1 and n >= {HOT}").groupBy(F.floor(F.log2(F.col("n"))).cast("int").alias("level")).agg(F.count(F.lit(1)).alias("n")).collect()}
    level = next(k for k in range(65) if sum(n for v, n in levels.items() if v >= k) <= TABLE)
    hot = seen.where(f"kind = 1 and n >= {max(HOT, 1 << level)}").select("key").toPandas()["key"].to_numpy().astype(np.int64).view(np.uint64)  # TABLE rows at most
    once = cut(sort_buckets(packed(own, hot, buckets, size), buckets, size, Sorted.of_strings))
    again = sort_buckets(once.where("payload is not null"), buckets, size, Sorted.of_windows, last=True)
    found = once.where("payload is null").union(again)
    found = cut(found.groupBy("doc", "text_hash").agg(F.flatten(F.collect_list(F.array("low", "high"))).alias("windows")))
    marks = docs.sparkSession.sparkContext.broadcast(_marks(found))

    added = [T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("kept_text", T.StringType())]
    keep = [c for c in docs.columns if c not in {f.name for f in added}]
    # a row's own columns travel as one, so their names can't clash with these
    rows = docs.select(F.struct(*keep).alias("own"), F.coalesce("doc_id", F.lit(int(LAST))).alias("doc"), F.xxhash64(text).alias("text_hash"), F.col(text).alias("text"))
    rows = rows.withColumn("mark", F.pmod(F.xxhash64("doc", "text_hash"), F.lit(MARKS)))

    def marked(part: pa.RecordBatch) -> pa.Array:
        at = part.column(part.schema.get_field_index("mark")).to_numpy()
        return pa.array((marks.value[at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1).astype(bool))

    def cleaned(part: pa.RecordBatch, lists: pa.Array) -> pa.RecordBatch:
        w = words(part.column(part.schema.get_field_index("text")), hashes=0)
        bounds, change = w.bounds(), np.zeros(len(w.start) + 1, np.int64)
        pairs = lists.flatten().to_numpy(zero_copy_only=False).reshape(-1, 2).astype(np.int64)
        base = np.repeat(bounds[:-1], pc.list_value_length(lists).fill_null(0).to_numpy(zero_copy_only=False) // 2)
        np.add.at(change, base + pairs[:, 0], 1)
        np.add.at(change, base + pairs[:, 1] + size, -1)
        gone = np.cumsum(change[:-1]) > 0
        lost = np.concatenate([[0], np.cumsum(gone)])
        data, ends = gather(np.append(w.buf, np.uint8(0x20)), w.start[~gone], w.end[~gone] + 1)
        data[ends[1:] - 1] = 0x20
        left = bounds - lost[bounds]
        kept = pa.Array.from_buffers(pa.large_string(), part.num_rows, [None, pa.py_buffer(ends[left].tobytes()), pa.py_buffer(data.tobytes())])
        kept = pc.utf8_slice_codeunits(kept, 0, -1).cast(pa.string())
        return pa.RecordBatch.from_arrays([part.column(part.schema.get_field_index("own")), pa.array(np.diff(bounds)), pa.array(np.diff(lost[bounds])), kept], names=["own", *(f.name for f in added)])

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text", 4 << 20):
            part = part.filter(pc.invert(marked(part)))
            if part.num_rows:
                yield cleaned(part, pa.nulls(part.num_rows, pa.list_(pa.int32())))

    def travelling(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(marked(batch))

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text", 4 << 20):
            yield cleaned(part, part.column(part.schema.get_field_index("windows")))

    schema = T.StructType([rows.schema["own"], *added])
    some = rows.mapInArrow(travelling, rows.schema).join(found, ["doc", "text_hash"], "left").select("own", "text", "windows")
    return rows.mapInArrow(whole, schema).union(some.mapInArrow(joined, schema)).select("own.*", *(f.name for f in added))


def dedup(docs: DataFrame) -> DataFrame:
    """docs with texts without their repeated windows, and n_chars to match; texts that lose nothing stay as they are."""
    out = remove_repeats(docs)
    new = F.when(F.col("n_removed") > 0, F.col("kept_text")).otherwise(F.col("text"))
    return out.withColumn("text", new).withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))
