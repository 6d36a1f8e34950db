"""Documents attributed to groups by their words (G8): the group whose mean TF-IDF vector is most alike.

Texts are read twice and never shuffled. The first pass sums c / m (a term's count over the document's distinct terms) by term and group:
a group's mean is that sum times the term's idf over the group's documents, so no weight is written for it. The second pass holds a
bounded table of the most frequent terms, by which most of a document's dot products are summed where it stands; only its other, rare
terms meet their means by a join. Terms are told by 64-bit hashes.

Defined results: a row is a document; rows that share an id are summed up; rows without id count for a term's frequency alone, as in SQL;
rows without group are attributed, but have no mean; a document that shares no term with a group is not attributed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnwright.functions.text import STOP_WORDS
from turnwright.operators import vectors
from turnwright.session import Shelf, scratch, written

#: Numbers in the table of frequent terms; bytes of text, and sums, that a task works on at once.
TABLE, TEXT, SUMS = 1 << 22, 4 << 20, 1 << 20
_INK = np.zeros(256, bool)
_INK[[*b"abcdefghijklmnopqrstuvwxyz0123456789"]] = True
_MASK = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
_STEP, LONG = np.uint64(0xD1342543DE82EF95), 64


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _hashes(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A hash of each range of bytes; eight bytes must follow the last one."""
    size = end - start
    out = _mix(size.astype(np.uint64) * _STEP)
    eights = np.ndarray(max(len(buf) - 7, 0), "<u8", buf, strides=(1,))
    some, at = np.flatnonzero(size <= LONG), 0
    while len(some):
        out[some] = _mix(out[some] ^ (eights[start[some] + at] & _MASK[np.minimum(size[some] - at, 8)]))
        at += 8
        some = some[size[some] > at]
    for k in np.flatnonzero(size > LONG).tolist():
        out[k] = int.from_bytes(hashlib.blake2b(buf[start[k] : end[k]].tobytes(), digest_size=8).digest(), "little")
    return out


def term_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of each term of lower-case texts: runs of over two of a-z and 0-9 that aren't stop words."""
    texts = texts.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    buf = np.append(np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8), np.zeros(8, np.uint8))
    offsets = offsets - offsets[0]
    ink, edge = _INK[buf[: offsets[-1] + 1]], np.zeros(offsets[-1] + 1, bool)
    edge[offsets] = True
    before = np.append(False, ink[:-1])
    start, end = np.flatnonzero(ink & (~before | edge)), np.flatnonzero(before & (~ink | edge))
    long = end - start > 2
    start, end = start[long], end[long]
    found = _hashes(buf, start, end)
    words = not_terms()
    known = words[np.minimum(np.searchsorted(words, found), len(words) - 1)] == found
    return np.searchsorted(offsets[1:], start[~known], side="right"), found[~known]


def not_terms() -> np.ndarray:
    """The hashes of stop words, in order."""
    text = " ".join(STOP_WORDS).encode() + b" "
    buf, ends = np.frombuffer(text + bytes(8), np.uint8), np.flatnonzero(np.frombuffer(text, np.uint8) == 32)
    return np.sort(_hashes(buf, np.append(0, ends[:-1] + 1), ends))


def _counted(*columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order of rows by these columns, first by the last, and where in it each distinct row begins."""
    order = np.lexsort(columns)
    new = np.zeros(len(order), bool)
    new[:1] = True
    for c in columns:
        new[1:] |= c[order][1:] != c[order][:-1]
    return order, np.flatnonzero(new)


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(rows, row, hash, c, m) of slices of batches (doc, group, text): each row's distinct terms in order, their counts, and how many a row has."""
    for batch in batches:
        size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(2)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(size, (size[at - 1] if at else 0) + TEXT, side="right")))
            rows = batch.slice(at, to - at)
            row, term = term_hashes(rows.column(2))
            order, first = _counted(term, row)
            yield rows, row[order][first], term[order][first], np.diff(np.append(first, len(order))), np.bincount(row[order][first], minlength=rows.num_rows)
            at = to


def term_sums(docs: DataFrame) -> DataFrame:
    """(term, df, by) from docs (doc, group, text): in how many rows each term is, and by group the sum of c / m; for the null term, the number of rows with a term, in all and by group."""
    kind = docs.schema["group"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes: dict = {}
        held: list[tuple[np.ndarray, ...]] = []
        docs_of: dict[int, int] = {}

        def summed() -> tuple[np.ndarray, ...]:
            group, term, s, n = (np.concatenate(x) for x in zip(*held, strict=True))
            order, first = _counted(group, term)
            return group[order][first], term[order][first], np.add.reduceat(s[order], first), np.add.reduceat(n[order], first)

        def rows(group: list, term: pa.Array, s: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
            names = pa.array(list(codes), pa_kind).take(pa.array(group))
            return pa.RecordBatch.from_arrays([term, names, pa.array(s), pa.array(n)], names=["term", "group", "s", "n"])

        pa_kind = pa.string()
        for part, row, term, c, m in _pairs(batches):
            pa_kind = part.column(1).type
            group = np.array([codes.setdefault(g, len(codes)) for g in part.column(1).to_pylist()], np.int64)
            known = part.column(0).is_valid().to_numpy(zero_copy_only=False)
            for g, many in zip(*np.unique(group[known & (m > 0)], return_counts=True), strict=True):
                docs_of[int(g)] = docs_of.get(int(g), 0) + int(many)
            if len(term):
                held.append((group[row], term, np.where(known[row], c / np.maximum(m[row], 1), 0.0), np.ones(len(term), np.int64)))
            if sum(len(x[0]) for x in held) > SUMS:
                held = [summed()]
                if len(held[0][0]) > SUMS // 2:
                    g, t, s, n = held.pop()
                    yield rows(g, pa.array(t.view(np.int64)), s, n)
        if held:
            g, t, s, n = summed()
            yield rows(g, pa.array(t.view(np.int64)), s, n)
        if docs_of:
            many = np.array(list(docs_of.values()), np.int64)
            yield rows(list(docs_of), pa.nulls(len(many), pa.int64()), many.astype(np.float64), many)

    sums = docs.mapInArrow(run, f"term long, group {kind}, s double, n long").repartition("term")
    each = sums.groupBy("term", "group").agg(F.sum("s").alias("s"), F.sum("n").alias("n"))
    by = F.map_from_entries(F.collect_list(F.when(F.col("group").isNotNull() & (F.col("s") > 0), F.struct("group", "s"))))
    return each.groupBy("term").agg(F.sum("n").alias("df"), by.alias("by"))


def _dotted(docs: DataFrame, table: tuple[np.ndarray, np.ndarray, np.ndarray]) -> DataFrame:
    """(doc, m, own, dots, rare, c): of each row with terms, the square of its length and its dot products, as far as the table (terms, idf, vectors) has its terms, and the others with their counts."""
    shared = docs.sparkSession.sparkContext.broadcast(table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, idf, units = shared.value
        for part, row, term, c, m in _pairs(batches):
            known = part.column(0).is_valid().to_numpy(zero_copy_only=False)[row]
            row, term, c = row[known], term[known], c[known]
            if not len(row):
                continue
            at = np.minimum(np.searchsorted(terms, term), max(len(terms) - 1, 0))
            hit = terms[at] == term if len(terms) else np.zeros(len(term), bool)
            x, own, dots = c / m[row], np.zeros(len(m)), np.zeros((len(m), units.shape[1]))
            for k in range(0, len(row), 1 << 16):
                some = np.flatnonzero(hit[k : k + (1 << 16)]) + k
                if len(some):
                    first = np.flatnonzero(np.append(True, np.diff(row[some]) > 0))
                    own[row[some][first]] += np.add.reduceat((x[some] * idf[at[some]]) ** 2, first)
                    dots[row[some][first]] += np.add.reduceat(units[at[some]] * x[some][:, None], first, axis=0)
            rows, begin = np.unique(row, return_index=True)
            left = np.append(0, np.cumsum(~hit))[np.append(begin, len(row))].astype(np.int32)
            dots_at = (np.arange(len(rows) + 1) * units.shape[1]).astype(np.int32)
            columns = [
                part.column(0).take(pa.array(rows)), pa.array(m[rows]), pa.array(own[rows]), pa.ListArray.from_arrays(pa.array(dots_at), pa.array(dots[rows].ravel())),
                pa.ListArray.from_arrays(pa.array(left), pa.array(term[~hit].view(np.int64))), pa.ListArray.from_arrays(pa.array(left), pa.array(c[~hit].astype(np.int32))),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["doc", "m", "own", "dots", "rare", "c"])

    return docs.mapInArrow(run, f"doc {docs.schema['doc'].dataType.simpleString()}, m long, own double, dots array<double>, rare array<long>, c array<int>")


def attributed(docs: DataFrame, doc: str, group: str, text: str, grain: int, table: int | None = None) -> DataFrame:
    """(doc, group) of the group whose mean TF-IDF vector is most alike (cosine, to 1/grain; ties to the least name). table: numbers in the table of frequent terms."""
    spark, shelf = docs.sparkSession, Shelf(docs.sparkSession)
    docs = docs.select(F.col(doc).alias("doc"), F.col(group).alias("group"), F.lower(text).alias("text"))
    sums = shelf.put(term_sums(docs))
    total = sums.where("term is null").select("df", F.size("by").alias("groups")).first() or (0, 0)
    many = sums.where("term is null").select(F.explode("by").alias("group", "k"))
    wide = total[1] <= vectors.WIDE
    if wide:  # a row for each group
        many = F.broadcast(many)
    idf = F.log((F.lit(float(total[0])) + 1.0) / (F.col("df") + 1.0)) + 1.0
    terms = sums.where("term is not null").withColumn("idf", idf)
    means = terms.select("term", "idf", F.explode("by").alias("group", "s")).join(many, "group").select("group", "term", (F.col("s") * F.col("idf") / F.col("k")).alias("m"))
    lengths = means.groupBy("group").agg(F.sqrt(F.sum(F.col("m") * F.col("m"))).alias("length")).join(many, "group").orderBy("group").collect() if wide else []
    names, scale = [r["group"] for r in lengths], np.array([1 / r["length"] / r["k"] for r in lengths])

    rank = F.floor(F.log2("df") * 4).cast("int")
    ranks = {r.rank: r.n for r in terms.groupBy(rank.alias("rank")).agg(F.count(F.lit(1)).alias("n")).collect()} if wide else {}
    room = (TABLE if table is None else table) // (len(names) + 2)
    least = min((k for k in ranks if sum(n for r, n in ranks.items() if r >= k) <= room), default=1 << 30)
    some = terms.where(rank >= least).select("term", "idf", F.map_keys("by").alias("g"), F.map_values("by").alias("s")).toArrow().combine_chunks()
    order = np.argsort(some["term"].to_numpy().view(np.uint64))
    idfs, units = some["idf"].to_numpy(), np.zeros((len(some), len(names)))
    if len(some):
        place = {g: k for k, g in enumerate(names)}
        at = np.array([place[g] for g in some["g"].combine_chunks().flatten().to_pylist()], np.int64)
        line = np.repeat(np.arange(len(some)), some["g"].combine_chunks().value_lengths().to_numpy())
        units[line, at] = some["s"].combine_chunks().flatten().to_numpy() * idfs[line] ** 2 * scale[at]
    dotted = shelf.put(_dotted(docs.drop("group").withColumn("group", F.lit(None).cast("string")).select("doc", "group", "text"), (some["term"].to_numpy().view(np.uint64)[order], idfs[order], units[order])))

    rare = dotted.select("doc", "m", F.explode(F.arrays_zip("rare", "c")).alias("p")).select("doc", F.col("p.rare").alias("term"), (F.col("p.c") / F.col("m")).alias("x"))
    if wide:
        left = terms.where(rank < least).select("term", "idf", *((F.col("by")[F.lit(g)] * F.col("idf") * F.col("idf") * F.lit(float(scale[k]))).alias(f"u{k}") for k, g in enumerate(names)))
        found = rare.join(left, "term").select("doc", ((F.col("x") * F.col("idf")) ** 2).alias("own"), *((F.col("x") * F.col(f"u{k}")).alias(f"dot{k}") for k in range(len(names))))
        both = dotted.select("doc", "own", *(F.get("dots", F.lit(k)).alias(f"dot{k}") for k in range(len(names)))).union(found)
        dots = both.groupBy("doc").agg(F.sqrt(F.sum("own")).alias("own"), *(F.sum(f"dot{k}").alias(f"dot{k}") for k in range(len(names))))
        each = [F.when(F.col(f"dot{k}") > 0, F.struct((-F.floor(F.col(f"dot{k}") / F.col("own") * grain)).alias("s"), F.lit(g).alias("g"))) for k, g in enumerate(names)]
        best = F.array_min(F.array(*each))["g"] if each else F.lit(None)
        out = dots.select("doc", best.cast(docs.schema["group"].dataType).alias("group")).where(F.col("group").isNotNull())
    else:
        out = vectors.nearest_mean(rare.join(terms.select("term", "idf"), "term").select("doc", "term", (F.col("x") * F.col("idf")).alias("weight")), means, "doc", "group", grain)
    out = written(out, scratch(spark), compression="zstd")
    shelf.clear()
    return out.select(F.col("doc").alias(doc), F.col("group").alias(group))
