"""N-gram Jaccard join: a size-aware heavy-light join of the documents' sets of word shingles, reduced to components.

Documents with equal sets form a class; only classes are joined. With similarity S, sets of at most m shingles that link
have c(m) = ceil(S m) in common, m being the larger size. Light sets (size up to a boundary) put every subset of each such fixed
size c that a partner may call for in an index. Heavy sets put their prefix in inverted lists that are scanned: the
size - ceil(S size) + 1 rarest shingles, one of which two linked sets must share. Rare means: not in a bounded table of the most
frequent shingles; any such order finds all links, a good one makes the lists short. Sets with more shingles that no other set has
than a link allows are found first, by scans of all inverted lists, a part of the shingles' range after the other, and put out nothing.
Only a class's first document puts out keys.
The boundary is the one of least cost, by the sizes of all sets: subsets put out, against list entries times the mean list.
A list is not expanded into pairs. Each has a hub, the class of most documents in it, and its classes are held against the hub by their
whole sets, in tasks of at most STAR classes; verified links are united. A list whose other classes are then still apart is worked through
once more without its hub, with another one. What STARS rounds leave apart (few classes, unless texts only seem alike) is compared
group by group: within a group only classes not yet connected, of sizes that can link; groups of over BLOCK shingles are cut in blocks
by size, and each pair of blocks is a task, so nothing is unbounded and no link is lost.

Defined results: rows with equal texts, or repeated doc_ids, are rows of their own with the same class; a null or empty text
has no shingles and is its own component; a row without doc_id is linked with nothing and has no component; with fewer words than
the shingle size, the whole sequence is one shingle; other columns are ignored, or passed on by dedup().
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from turnwright.llm.clusterio import Shelf, kept, scratch, table
from turnwright.llm.words import Words, mix, ngrams, slices, words
from turnwright.operators.graph import components

SIZE, SIMILARITY = 5, 80
#: Shingles in the table of frequent ones; the largest light set; classes that a task holds against a hub; rounds of hubs.
FREQUENT, LIGHTEST, STAR, STARS = 1 << 18, 12, 64, 2
#: Shingles of a group, or of a block of one, that a task compares: blocks are so large at least; a group has so many, unless blocks were larger than the last number.
BLOCK, BLOCKS, LARGEST = 16_000, 64, 2_000_000
#: Places that rows of one group are dealt to where they meet what is known of the group.
SALTS = 32
#: Shingles of a piece of input; bytes of text for each bucket of shingles; times that make one frequent; marks of documents.
SEEN, BUCKET, OFTEN, ALIVE = 1_000_000, 8 << 20, 4, 1 << 22
#: Parts of the shingles' range, each of which is surveyed by a pass of its own; bits by which a survey tells shingles apart, beyond those that number them.
PARTS, SPARE = 3, 5


def overlap(size: int, s: int = SIMILARITY) -> int:
    """The shingles that a set of this size shares with any linked set that isn't larger."""
    return -(-s * size // 100)


def shingle_sets(w: Words, size: int = SIZE) -> list[np.ndarray]:
    """Of each row, the sorted hashes of its distinct shingles."""
    grams, bounds, out = ngrams(w.hash, size), w.bounds(), []
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        if b - a >= size:
            out.append(np.unique(grams[a : b - size + 1]))
        else:
            out.append(ngrams(w.hash[a:b], b - a)[:1] if b > a else np.zeros(0, np.uint64))
    return out


def class_id(s: np.ndarray) -> int:
    """A 64-bit hash of a set."""
    return int(mix(np.sum(mix(s + np.uint64(1)), keepdims=True) + np.uint64(len(s)))[0].astype(np.int64))


def subset_sizes(size: int, s: int = SIMILARITY) -> list[int]:
    """The sizes of common subsets that a linked set, as large or larger, may call for."""
    return sorted({overlap(m, s) for m in range(size, 100 * size // s + 1)})


def light_cost(size: int, s: int = SIMILARITY) -> int:
    return sum(comb(size, c) for c in subset_sizes(size, s) if c <= size)


def boundary(sizes: dict[int, int], mean_list: float, s: int = SIMILARITY) -> int:
    """The largest light size at which subsets of light sets and list entries of heavy ones cost least together."""

    def cost(x: int) -> float:
        light = sum(n * light_cost(k, s) for k, n in sizes.items() if k <= x)
        return light + sum(n * (k - overlap(k, s) + 1) * mean_list for k, n in sizes.items() if 100 * k // s > x)

    return min(range(LIGHTEST + 1), key=cost)


def _pack(*columns: np.ndarray) -> bytes:
    """Columns of numbers, each by bytes of equal weight, compressed."""
    parts = [np.array([len(columns[0])]).tobytes(), *(c.view(np.uint8).reshape(len(c), -1).T.tobytes() for c in columns)]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(parts))


def _unpack(payload: bytes, *kinds: type) -> list[np.ndarray]:
    data = zstandard.decompress(payload)
    n, at, out = int(np.frombuffer(data, np.int64, 1)[0]), 8, []
    for kind in kinds:
        width = np.dtype(kind).itemsize
        out.append(np.ascontiguousarray(np.frombuffer(data, np.uint8, n * width, at).reshape(width, n).T).view(kind).ravel())
        at += n * width
    return out


def _rows(kind: int, bucket: list[int], key: list[int], n: list[int], payload: list[bytes] | None = None) -> pa.RecordBatch:
    many = len(bucket)
    columns = [pa.array(np.full(many, kind, np.int32)), pa.array(bucket, pa.int64()), pa.array(key, pa.int64()), pa.array(n, pa.int64()), pa.array(payload or [None] * many, pa.binary())]
    return pa.RecordBatch.from_arrays(columns, names=["kind", "bucket", "key", "n", "payload"])


SURVEY = "kind int, bucket long, key long, n long, payload binary"


def survey(docs: DataFrame, buckets: int, part: int = 0, parts: int = 1, bits: int = 48, size: int = SIZE, s: int = SIMILARITY) -> DataFrame:
    """(kind, key, n, doc_id, lone): of kind 0, each document's class, set size and id, and how many shingles of this part no other set has; of kind 1, counts of this part's most frequent shingles.

    Pieces of the input send their sorted shingles to buckets by range, each once: with its document if it is in one only,
    else with the count. A bucket's lists tell which occur nowhere else. A set with so many of these, all parts together, that the rest
    is less than links call for has no link, and is left out of all that follows. Shingles are told apart by their first bits, so chance
    may only let a set through. Of documents with one class none has a lone shingle, so parts may be summed by class.
    """
    own_buckets = range(buckets * part // parts, buckets * (part + 1) // parts)
    edges = (np.arange(own_buckets.start, own_buckets.stop + 1, dtype=np.float64) / buckets * 2.0**bits).astype(np.uint64)
    shift, most = np.uint64(64 - bits), max(1024, 4 * FREQUENT // buckets)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pending: list[tuple[int | None, int, int, np.ndarray]] = []
        many, piece = 0, (TaskContext.get().partitionId() if TaskContext.get() else 0) << 32

        def sent() -> Iterator[pa.RecordBatch]:
            every = np.concatenate([x for *_, x in pending])
            doc = np.repeat(np.arange(len(pending), dtype=np.int32), [len(x) for *_, x in pending])
            value, first, n = np.unique(every, return_index=True, return_counts=True)
            mark = np.where(n == 1, doc[first], -np.minimum(n, 1 << 30)).astype(np.int32)
            at = np.searchsorted(value, edges)
            out = [(k, _pack(np.diff(value[a:b], prepend=np.uint64(0)), mark[a:b])) for k, a, b in zip(own_buckets, at[:-1], at[1:], strict=True) if b > a]
            yield _rows(2, [k for k, _ in out], [piece] * len(out), [len(pending)] * len(out), [x for _, x in out])
            ids, names, sizes, _ = zip(*pending, strict=True)
            known = np.array([x is not None for x in ids])
            columns = np.array([x or 0 for x in ids], np.int64), known, np.array(names, np.int64), np.array(sizes, np.int64)
            yield _rows(0, [piece % buckets], [piece], [len(pending)], [_pack(*columns)])

        for piece_of in slices(batches, "text", 2 << 20):
            for doc_id, own in zip(piece_of.column(0).to_pylist(), shingle_sets(words(piece_of.column(1), lower=True), size), strict=True):
                value = own >> shift
                a, b = np.searchsorted(value, edges[[0, -1]])
                pending.append((doc_id, class_id(own), len(own), value[a:b].copy()))
                many += b - a + 1
                if many > SEEN:
                    yield from sent()
                    pending, many, piece = [], 0, piece + 1
        if pending:
            yield from sent()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, int, bytes]] = []
        current = None

        def ended() -> Iterator[pa.RecordBatch]:
            if not held:
                return
            lists = [_unpack(payload, np.uint64, np.int32) for _, _, payload in held]
            value = np.concatenate([np.cumsum(v, dtype=np.uint64) for v, _ in lists])
            mark, source = np.concatenate([m for _, m in lists]), np.repeat(np.arange(len(lists), dtype=np.int32), [len(m) for _, m in lists])
            order = np.argsort(value, kind="stable")
            start = np.flatnonzero(np.append(True, np.diff(value[order]) > 0))
            lone = order[start[np.diff(np.append(start, len(order))) == 1]]
            lone = lone[mark[lone] >= 0]
            times = np.add.reduceat(np.where(mark < 0, -mark, 1)[order].astype(np.int64), start)
            often = np.flatnonzero(times >= OFTEN)
            often = often[np.argsort(-times[often], kind="stable")[:most]]
            yield _rows(1, [current] * len(often), value[order][start[often]].astype(np.int64).tolist(), times[often].tolist())
            lone = lone[np.argsort(source[lone], kind="stable")]
            ends = np.searchsorted(source[lone], np.arange(len(held) + 1))
            counts = [_pack(np.bincount(mark[lone[a:b]], minlength=n).astype(np.int32)) for (_, n, _), a, b in zip(held, ends[:-1], ends[1:], strict=True)]
            yield _rows(2, [0] * len(held), [piece for piece, _, _ in held], [n for _, n, _ in held], counts)

        for batch in batches:
            known = batch.filter(pc.equal(batch.column(0), 0))
            if known.num_rows:
                yield known
            batch = batch.filter(pc.equal(batch.column(0), 2))
            for bucket, piece, n, payload in zip(*(batch.column(k).to_pylist() for k in range(1, 5)), strict=True):
                if bucket != current:
                    yield from ended()
                    held, current = [], bucket
                held.append((piece, n, payload))
        yield from ended()

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, docs_of, lone = None, None, None

        def ended() -> Iterator[pa.RecordBatch]:
            if docs_of is not None:
                ids, known, names, sizes = docs_of
                columns = [np.zeros(len(names), np.int32), names, sizes, pa.array(ids, mask=~known), lone]
                if part:  # the first part's rows say the rest
                    columns = [x.take(pa.array(np.flatnonzero(lone))) for x in map(pa.array, columns)]
                yield pa.RecordBatch.from_arrays([pa.array(x) if isinstance(x, np.ndarray) else x for x in columns], names=["kind", "key", "n", "doc_id", "lone"])

        for batch in batches:
            often = batch.filter(pc.equal(batch.column(0), 1))
            if often.num_rows:
                none = pa.nulls(often.num_rows, pa.int64())
                yield pa.RecordBatch.from_arrays([*(often.column(k) for k in (0, 2, 3)), none, none], names=["kind", "key", "n", "doc_id", "lone"])
            batch = batch.filter(pc.not_equal(batch.column(0), 1))
            for kind, piece, n, payload in zip(*(batch.column(k).to_pylist() for k in (0, 2, 3, 4)), strict=True):
                if piece != current:
                    yield from ended()
                    current, docs_of, lone = piece, None, np.zeros(n, np.int64)
                if kind == 0:
                    docs_of = _unpack(payload, np.int64, np.bool_, np.int64, np.int64)
                else:
                    lone += _unpack(payload, np.int32)[0]
        yield from ended()

    sent = docs.select("doc_id", "text").mapInArrow(send, SURVEY).repartition("bucket").sortWithinPartitions("bucket")
    return sent.mapInArrow(count, SURVEY).repartition("key").sortWithinPartitions("key").mapInArrow(judge, "kind int, key long, n long, doc_id long, lone long")


def signatures(docs: DataFrame, frequent: np.ndarray, counts: np.ndarray, bits: int, light: int, size: int = SIZE, s: int = SIMILARITY) -> DataFrame:
    """(doc_id, class, keys) of every document: the class's keys in the index of subsets and the inverted lists."""
    shared, shift = docs.sparkSession.sparkContext.broadcast((frequent, counts)), np.uint64(64 - bits)

    def keys(own: np.ndarray) -> np.ndarray:
        n, out = len(own), []
        if n <= light:
            for c in subset_sizes(n, s):
                if c <= n:
                    picked = np.array(list(combinations(range(n), c)), np.int64).reshape(-1, c)
                    out.append(mix(mix(own[picked]).sum(axis=1, dtype=np.uint64) + np.uint64(0x5EED << 8 | c)))
        if 100 * n // s > light:
            often, known = np.zeros(n, np.int64), shared.value[0]
            if len(known):
                at = np.minimum(np.searchsorted(known, own >> shift), len(known) - 1)
                often = np.where(known[at] == own >> shift, shared.value[1][at], 0)
            out.append(own[np.argsort(often, kind="stable")[: n - overlap(n, s) + 1]] if often.any() else own[: n - overlap(n, s) + 1])
        return np.concatenate(out).astype(np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            sets = shingle_sets(words(part.column(1), lower=True), size)
            found = [keys(x) if len(x) else np.zeros(0, np.int64) for x in sets]
            ends = np.cumsum([0, *map(len, found)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array([class_id(x) for x in sets], pa.int64()), pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(found)))],
                names=["doc_id", "class", "keys"],
            )

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, class long, keys array<long>")


def clusters(sets: list[np.ndarray], s: int = SIMILARITY, label: np.ndarray | None = None) -> np.ndarray:
    """Labels of the sets such that linked sets, and only sets with a chain of links, have the same. label: sets known to be connected."""
    m = len(sets)
    label = np.arange(m) if label is None else label.copy()
    size = np.array([len(x) for x in sets])
    ends = np.concatenate([[0], np.cumsum(size)])
    _, ids, often = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(m), size)
    order = np.argsort(ids, kind="stable")
    lists, list_ends = owner[order], np.concatenate([[0], np.cumsum(often)])
    mark, probed = np.zeros(len(often), bool), np.zeros(m, bool)
    while True:
        # a link between two labels has an end outside the largest, and is found from there
        largest = np.bincount(label).argmax()
        left = np.flatnonzero(~probed & (label != largest))
        if not len(left):
            return label
        a = left[0]
        probed[a] = True
        own = ids[ends[a] : ends[a + 1]]
        rare = own[np.argsort(often[own], kind="stable")[: size[a] - overlap(int(size[a]), s) + 1]]
        near = np.zeros(m, bool)
        for t in rare:
            near[lists[list_ends[t] : list_ends[t + 1]]] = True
        near &= (label != label[a]) & (100 * size >= s * size[a]) & (100 * size[a] >= s * size)
        near = np.flatnonzero(near)
        if not len(near):
            continue
        mark[own] = True
        for k in range(0, len(near), 256):
            some = near[k : k + 256]
            shared = np.array([np.count_nonzero(mark[ids[ends[b] : ends[b + 1]]]) for b in some])
            linked = some[100 * shared >= s * (size[a] + size[some] - shared)]
            if len(linked):
                label[np.isin(label, label[linked])] = label[a]
        mark[own] = False


def marked(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """docs with __marked: whether a doc_id may be among ids (doc_id); surely true of those that are. The marks, ALIVE bits at most, are broadcast as bitmaps."""
    at = F.pmod(F.xxhash64("doc_id"), F.lit(ALIVE))
    own = ids.select(at.alias("at"))
    marks = own.groupBy(F.bitmap_bucket_number("at").alias("__bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("__bits"))
    both = docs.withColumn("__at", F.bitmap_bit_position(at)).withColumn("__bucket", F.bitmap_bucket_number(at)).join(F.broadcast(marks), "__bucket", "left")
    bit = F.expr("getbit(cast(conv(hex(substring(__bits, cast(__at div 8 as int) + 1, 1)), 16, 10) as bigint), cast(__at % 8 as int)) = 1")
    return both.withColumn("__marked", F.coalesce(bit, F.lit(False))).drop("__at", "__bucket", "__bits")


def set_table(classes: DataFrame, docs: DataFrame, size: int = SIZE) -> DataFrame:
    """(class, payload): the set of each class, from the document that stands for it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            sets = shingle_sets(words(part.column(1), lower=True), size)
            names = part.column(0).to_numpy()
            some = [(name, _pack(np.diff(own, prepend=np.uint64(0)))) for name, own in zip(names.tolist(), sets, strict=True) if class_id(own) == name]
            yield pa.RecordBatch.from_arrays([pa.array([n for n, _ in some], pa.int64()), pa.array([x for _, x in some], pa.binary())], names=["class", "payload"])

    classes = classes.select("class", "doc_id")
    return classes.join(marked(docs, classes).where("__marked"), "doc_id").select("class", "text").mapInArrow(run, "class long, payload binary")


def _set(payload: bytes) -> np.ndarray:
    return np.cumsum(_unpack(payload, np.uint64)[0], dtype=np.uint64)


def star_tasks(stars: DataFrame, sets: DataFrame) -> DataFrame:
    """(task, side, class, payload): pairs (class, hub) as tasks of at most STAR classes or so; side 0 is the hub."""
    chunks = stars.groupBy("hub").agg(F.ceil(F.count(F.lit(1)) / STAR).cast("int").alias("chunks"))
    task = F.xxhash64("hub", "chunk").alias("task")
    each = stars.join(chunks, "hub").withColumn("chunk", F.expr("pmod(xxhash64(class), chunks)").cast("int")).select(task, F.lit(1).alias("side"), "class")
    hubs = chunks.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).select(task, F.lit(0).alias("side"), F.col("hub").alias("class"))
    return each.union(hubs).join(sets, "class").select("task", "side", "class", "payload")


def verified(rows: DataFrame, s: int = SIMILARITY) -> DataFrame:
    """(a, b): the links among the pairs of tasks, each class held against its hub's set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, name, hub = None, None, None
        for batch in batches:
            found = []
            for t, side, own, payload in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                if side == 0:
                    current, name, hub = t, own, _set(payload)
                elif t == current:
                    other = _set(payload)
                    shared = len(np.intersect1d(hub, other, assume_unique=True))
                    if 100 * shared >= s * (len(hub) + len(other) - shared):
                        found.append((own, name))
            yield pa.RecordBatch.from_arrays([pa.array([a for a, _ in found], pa.int64()), pa.array([b for _, b in found], pa.int64())], names=["a", "b"])

    return rows.repartition("task").sortWithinPartitions("task", "side").mapInArrow(run, "a long, b long")


def _with_group(members: DataFrame, groups: DataFrame) -> DataFrame:
    """members (class, task_root) with what groups say of each task_root; a large group's rows are dealt to SALTS places."""
    salted = groups.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return members.withColumn("salt", F.pmod(F.xxhash64("class"), F.lit(SALTS)).cast("int")).join(salted, ["task_root", "salt"]).drop("salt")


def _placed(entries: DataFrame, shelf: Shelf, s: int = SIMILARITY) -> DataFrame:
    """(task, class, part): which tasks compare which classes of entries (key, class, n, part), so that each pair of classes of one key, of different parts and of sizes that can link, meets in one."""
    lows = entries.groupBy("key").agg(F.min("class").alias("low"))
    groups = components(entries.join(lows, "key").select("class", "low"), "class", "low").select(F.col("node").alias("class"), F.col("root").alias("task_root"))
    members = entries.select("class", "n", "part").distinct().join(groups, "class")
    sizes = members.groupBy("task_root").agg(F.sum("n").alias("all"))
    members = shelf.put(_with_group(members, sizes))
    small = members.where(f"all <= {BLOCK}").select(F.xxhash64("task_root").alias("task"), "class", "part")
    large = members.where(f"all > {BLOCK}")
    parts = large.groupBy("task_root", "part").agg(F.sum("n").alias("n"))
    main = parts.groupBy("task_root").agg(F.max_by("part", F.struct("n", "part")).alias("main"))
    # sets that link are of one band of sizes or of neighbouring ones; two of the largest part needn't meet
    band = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(100.0 / s)) + 1e-9).cast("int")
    large = _with_group(large, main).select("task_root", "class", "n", "part", "all", (F.col("part") == F.col("main")).alias("large"), band.alias("band"))
    width = F.least(F.greatest(F.lit(BLOCK), F.max("all") / BLOCKS), F.lit(LARGEST))
    bands = large.groupBy("task_root", "band", "large").agg(F.ceil(F.sum("n") / width).cast("int").alias("blocks"))
    other = bands.select("task_root", F.col("band").alias("band2"), F.col("large").alias("large2"), F.col("blocks").alias("blocks2"))
    # neighbouring bands with one to spare, as a set may lie on a band's edge
    near = F.expr("band2 - band between 0 and 2 and not (large and large2) and (band2 > band or (large or not large2))")
    pairs = bands.join(other, "task_root").where(near).withColumn("i", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).withColumn("j", F.explode(F.sequence(F.lit(0), F.col("blocks2") - 1)))
    own = (F.col("band") == F.col("band2")) & (F.col("large") == F.col("large2"))
    pairs = pairs.where(~own | (F.col("i") <= F.col("j"))).withColumn("task", F.xxhash64("task_root", "band", "large", "i", "band2", "large2", "j"))
    ends = pairs.select("task_root", "task", "band", "large", F.col("i").alias("block")).union(pairs.where(~own | (F.col("i") < F.col("j"))).select("task_root", "task", "band2", "large2", "j"))
    large = large.join(bands, ["task_root", "band", "large"]).withColumn("block", F.expr("pmod(xxhash64(class), blocks)").cast("int"))
    return small.union(large.join(ends, ["task_root", "band", "large", "block"]).select("task", "class", "part"))


def compare(members: DataFrame, sets: DataFrame, s: int = SIMILARITY) -> DataFrame:
    """(a, b): classes that are connected by links, from members (task, class, part), compared within each task; classes of one part are known to be connected."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group: dict[int, tuple[int, np.ndarray]] = {}
        current = None

        def ended() -> Iterator[pa.RecordBatch]:
            if len(group) > 1:
                names = np.fromiter(group, np.int64, len(group))
                _, known = np.unique([part for part, _ in group.values()], return_inverse=True)
                label = clusters([own for _, own in group.values()], s, known)
                _, first = np.unique(label, return_index=True)
                root = names[first[np.searchsorted(np.unique(label), label)]]
                yield pa.RecordBatch.from_arrays([pa.array(names[names != root]), pa.array(root[names != root])], names=["a", "b"])

        for batch in batches:
            for task, name, part, payload in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                if task != current:
                    yield from ended()
                    group, current = {}, task
                group[name] = (part, _set(payload))
        yield from ended()

    rows = members.join(sets, "class").select("task", "class", "part", "payload")
    return rows.repartition("task").sortWithinPartitions("task").mapInArrow(run, "a long, b long")


def linked_classes(classes: DataFrame, docs: DataFrame, size: int = SIZE, s: int = SIMILARITY) -> DataFrame:
    """(class, root) of every class with a link, from classes (class, doc_id, n, copies, keys), which are written and read twice."""
    spark = classes.sparkSession
    shelf, lists, before = Shelf(spark), Shelf(spark), Shelf(spark)
    classes = before.put(classes)
    entries = classes.select("class", "n", "copies", F.explode("keys").alias("key"))
    several = entries.groupBy("key").agg(F.count(F.lit(1)).alias("m")).where("m > 1").select("key")
    entries = lists.put(entries.join(several, "key").withColumn("part", F.col("class")))
    met = shelf.put(classes.select("class", "doc_id").join(entries.select("class").distinct(), "class", "left_semi"))
    before.clear()
    sets = shelf.put(set_table(met, docs, size))
    links = roots = None
    for _ in range(STARS):
        if entries.isEmpty():
            break
        hubs = entries.groupBy("key").agg(F.max_by(F.struct("class", "n", "part"), F.struct("copies", "class")).alias("h"))
        rays = entries.join(hubs.select("key", F.col("h.class").alias("hub"), F.col("h.n").alias("hub_n"), F.col("h.part").alias("hub_part")), "key").where("class <> hub")
        stars = rays.where(f"part <> hub_part and 100 * least(n, hub_n) >= {s} * greatest(n, hub_n)").select("class", "hub").distinct()
        rows = Shelf(spark)
        found = shelf.put(verified(rows.put(star_tasks(stars, sets)), s))
        rows.clear()
        links = found if links is None else links.union(found)
        roots = shelf.put(components(links).select(F.col("node").alias("class"), "root"))
        # the hub was held against all; what its list still holds apart are the others
        rest, rays = Shelf(spark), rays.select("key", "class", "n", "copies").join(roots, "class", "left").select("key", "class", "n", "copies", F.coalesce("root", "class").alias("part"))
        rays = rest.put(rays)
        lists.clear()
        apart = rays.groupBy("key").agg(F.min("part").alias("a"), F.max("part").alias("b")).where("a < b").select("key")
        entries = lists.put(rays.join(apart, "key"))
        rest.clear()
    if not entries.isEmpty():
        found = shelf.put(compare(_placed(entries, shelf, s), sets, s))
        roots = components(found if links is None else links.union(found)).select(F.col("node").alias("class"), "root")
    if roots is not None:
        roots = kept(roots, scratch(spark))
    lists.clear()
    shelf.clear()
    return spark.createDataFrame([], "class long, root long") if roots is None else roots


def join(docs: DataFrame, size: int = SIZE, s: int = SIMILARITY) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of docs (doc_id, text)."""
    docs = docs.select("doc_id", "text")
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shelf = Shelf(docs.sparkSession)
    bits, buckets = min(48, max(total // 4, 1).bit_length() + SPARE), PARTS + total // BUCKET  # a shingle for four bytes at most, or nearly
    parts = [shelf.put(survey(docs, buckets, k, PARTS, bits, size, s)) for k in range(PARTS)]
    own = parts[0].where("kind = 0").select("doc_id", F.col("key").alias("class"), "n")
    sizes = {r.k: r.m for r in own.where("n > 0").groupBy(F.least("n", F.lit(4 * LIGHTEST)).cast("int").alias("k")).agg(F.count(F.lit(1)).alias("m")).collect()}
    seen = reduce(DataFrame.union, [x.where("kind = 1").select("key", "n") for x in parts])
    scale = {r.level: r.m for r in seen.groupBy(F.floor(F.log2(F.col("n"))).cast("int").alias("level")).agg(F.count(F.lit(1)).alias("m")).collect()}
    level = next(k for k in range(65) if sum(m for v, m in scale.items() if v >= k) <= FREQUENT)
    often = seen.where(f"n >= {1 << min(level, 62)}").toPandas()  # FREQUENT rows at most
    known = often["key"].to_numpy().astype(np.uint64)
    order = np.argsort(known)
    repeats = seen.agg(F.sum("n"), F.sum(F.col("n").cast("double") ** 2)).first()
    mean_list = 1 + (repeats[1] / repeats[0] if repeats[0] else 0)
    light = boundary(sizes, mean_list, s)

    # a class whose shingles are lone as often as no link allows, has none
    lone = reduce(DataFrame.union, [x.where("kind = 0").select("key", "n", "doc_id", "lone", (F.col("doc_id").isNotNull() if x is parts[0] else F.lit(False)).cast("long").alias("one")) for x in parts])
    lone = lone.withColumn("doc_id", F.when(F.col("one") == 1, F.col("doc_id")))
    of_classes = lone.groupBy(F.col("key").alias("class")).agg(F.min("doc_id").alias("doc_id"), F.max("n").alias("n"), F.sum("one").alias("copies"), F.sum("lone").alias("lone"))
    classes = shelf.put(of_classes.where(f"doc_id is not null and n > 0 and lone < n - (n * {s} + 99) div 100 + 1").drop("lone"))
    some = marked(docs, classes).where("__marked")
    keys = signatures(some, known[order], often["n"].to_numpy()[order], bits, light, size, s).join(classes, ["class", "doc_id"])
    roots = linked_classes(keys.groupBy("class", "doc_id", "n", "copies").agg(F.first("keys").alias("keys")), docs, size, s)
    labelled = classes.select("class", "doc_id").join(roots, "class", "left").withColumn("label", F.coalesce("root", "class"))
    lowest = labelled.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    of_class = labelled.join(lowest, "label").select("class", "component_id")
    out = own.withColumnRenamed("n", "n_shingles").join(of_class, "class", "left")
    component = F.when((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).otherwise(F.col("doc_id"))
    out = kept(out.select("doc_id", "n_shingles", component.alias("component_id")), scratch(docs.sparkSession))
    shelf.clear()
    return out


def told(docs: DataFrame, gone: DataFrame, stay: DataFrame) -> DataFrame:
    """docs with __stays: whether marks alone say that a row stays (true) or goes (false), null where they don't; gone and stay (doc_id) have every id between them."""
    may_go = marked(docs, gone).withColumnRenamed("__marked", "__may_go")
    sure = F.when(~F.col("__may_go") | F.col("doc_id").isNull(), True).when(~F.col("__marked"), False)
    return marked(may_go, stay).withColumn("__stays", sure).drop("__may_go", "__marked")


def dedup(docs: DataFrame) -> DataFrame:
    """docs without all but the first document of each component; of rows with the same doc_id, all or none stay. Only texts of documents of which marks don't tell are shuffled."""
    found = join(docs)
    first = kept(found.where("doc_id = component_id").select("doc_id").distinct(), scratch(docs.sparkSession))
    gone = kept(found.where("doc_id is not null").select("doc_id").distinct().join(first, "doc_id", "left_anti"), scratch(docs.sparkSession))
    split = told(docs, gone, first)
    return split.where("__stays").drop("__stays").union(split.where("__stays is null").drop("__stays").join(gone, "doc_id", "left_anti").select(docs.columns))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join(table(spark, sf_dir, "documents"))
