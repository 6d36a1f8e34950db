"""Benchmark decontamination: SimHash over windows as long as the benchmark's items, found by a multi-index, then verified.

Texts and items are read as words without case and punctuation. An item of n words is held against windows of n words of every document,
and against the whole text of a document of fewer words.
Each window has a SimHash of BITS bits of its weighted shingles (SIZE words, weight: occurrences), in BLOCKS blocks. Items are indexed by each
block and by what it is with one bit changed, and windows look up each of theirs likewise: so any pair that differs in at most NEAR bits of
some block is met, and two fingerprints that differ in at most RADIUS = BLOCKS (NEAR + 1) - 1 bits do so in some block. Pairs that are met,
about 3 % of the items by chance, are verified by the exact weighted Jaccard similarity of their shingles, which must be at least SIMILARITY percent.

Windows with fewer shingles of any item than similarity calls for can't be similar to one and get no fingerprint; all others do. A whole text that is
shorter than items needs no fingerprint: those that share enough of its shingles are looked up by shingle and verified.
What tasks hold of the benchmark is bounded however large it is: it is taken in blocks of at most ITEM_WORDS words. Of several blocks, one pass
over the documents keeps those that have any shingle of the benchmark in common with it, by a table of 2**MAYBE bits, and the blocks then read only these.

Defined results: a null or empty text is clean; a null or empty item leaks nowhere; an item without id isn't reported, but clean() heeds it; items of fewer words than a shingle are one shingle; equal
items, and rows with equal doc_ids, are reported each; other columns are ignored or, in clean(), passed on.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from turnwright.llm.clusterio import cut, table
from turnwright.llm.words import mix, ngrams, slices, words

SIZE, SIMILARITY, BITS = 5, 80, 256
#: Blocks of 16 bits; the bits of a block that may differ, one changed on either side of the index; and so the distance within which all pairs are met.
#: At the least similarity about 15 % of the bits differ, so a block of 16 differs in over two with a chance of 0.45: all of them in one of 400,000 pairs.
BLOCKS, NEAR = BITS // 16, 2
RADIUS = BLOCKS * (NEAR + 1) - 1
ITEM_WORDS, MAYBE = 1 << 20, 26
_PUNCTUATION = regex.compile(r"[^\p{L}\p{M}\p{N}\x20\x09-\x0D]+")


def plain(column: pa.Array) -> pa.Array:
    """Texts in lower case without characters other than letters, marks, digits and white space."""
    return pa.array([_PUNCTUATION.sub("", (t or "").lower()) for t in column.to_pylist()], pa.large_string())


def fingerprints(value: np.ndarray, weight: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """SimHashes of n weighted sets of 64-bit values, as rows of BITS / 64 numbers."""
    out = np.zeros((n, BITS // 64), np.uint64)
    place = np.arange(64, dtype=np.uint64)
    for k in range(BITS // 64):
        h = mix(value + np.uint64(0x51AC + k))
        for at in range(0, n, 4096):
            a, b = np.searchsorted(owner, [at, at + 4096])
            signs = (((h[a:b, None] >> place) & np.uint64(1)).astype(np.float32) * 2 - 1) * weight[a:b, None].astype(np.float32)
            total = np.zeros((min(4096, n - at), 64), np.float32)
            np.add.at(total, owner[a:b] - at, signs)
            out[at : at + 4096, k] = ((total > 0).astype(np.uint64) << place).sum(axis=1, dtype=np.uint64)
    return out


_FLIPS = np.array([0, *(1 << k for k in range(16))], np.int64)


def blocks(prints: np.ndarray) -> np.ndarray:
    """The keys of each fingerprint: each of its blocks, as it is and with each one of its bits changed, after the block's number."""
    value = prints.view("<u2").astype(np.int64)
    return ((value[:, :, None] ^ _FLIPS) | (np.arange(BLOCKS) << 16)[:, None]).reshape(len(prints), -1)


@dataclass
class Items:
    """Benchmark items of some number of words each, with a multi-index by blocks of their fingerprints."""

    ids: list[int]
    grams: list[np.ndarray]
    length: np.ndarray
    known: np.ndarray
    holders: np.ndarray
    first_holder: np.ndarray
    lengths_of: dict[int, np.ndarray]
    prints: np.ndarray
    places: np.ndarray
    keyed: np.ndarray

    @classmethod
    def of(cls, ids: list[int], texts: list[str]) -> Items:
        w = words(plain(pa.array(texts, pa.string())))
        bounds = w.bounds()
        length = np.diff(bounds)
        some = np.flatnonzero(length)
        grams = [np.sort(shingles(w.hash[bounds[k] : bounds[k + 1]])) for k in some]
        length = length[some]
        value, weight, owner = bags(grams)
        prints = fingerprints(value, weight, owner, len(grams))
        keys = blocks(prints).ravel() if len(grams) else np.zeros(0, np.int64)
        by_key = np.argsort(keys, kind="stable")
        places = np.searchsorted(keys[by_key], np.arange((BLOCKS << 16) + 1)).astype(np.int32)
        keyed = (by_key // (BLOCKS * len(_FLIPS))).astype(np.int32)
        order = np.argsort(value, kind="stable")
        known, first = np.unique(value[order], return_index=True)
        lengths: dict[int, set[int]] = {}
        for g, n in zip(grams, length.tolist(), strict=True):
            for x in g.tolist():
                lengths.setdefault(x, set()).add(n)
        return cls([ids[k] for k in some], grams, length, known, owner[order], np.append(first, len(order)), {x: np.array(sorted(n)) for x, n in lengths.items()}, prints, places, keyed)

    def met(self, keys: np.ndarray, length: int) -> np.ndarray:
        """Items of so many words that have one of the keys."""
        found = np.unique(np.concatenate([self.keyed[a:b] for a, b in zip(self.places[keys].tolist(), self.places[keys + 1].tolist(), strict=True) if b > a] or [np.zeros(0, np.int32)]))
        return found[self.length[found] == length]

    def sharing(self, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Items that have any of the sorted shingles, and how many of these at most are common."""
        value, count = np.unique(grams, return_counts=True)
        at = np.searchsorted(self.known, value)
        some = at < len(self.known)
        some[some] = self.known[at[some]] == value[some]
        total = np.zeros(len(self.grams), np.int64)
        for k, n in zip(at[some].tolist(), count[some].tolist(), strict=True):
            total[self.holders[self.first_holder[k] : self.first_holder[k + 1]]] += n
        near = np.flatnonzero(total)
        return near, total[near]

    def sizes(self) -> list[int]:
        return sorted({min(SIZE, int(n)) for n in self.length})


def shingles(hashes: np.ndarray) -> np.ndarray:
    return ngrams(hashes, min(SIZE, len(hashes))) if len(hashes) else np.zeros(0, np.uint64)


def bags(grams: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct values of each list, their occurrences, and the list's number."""
    pairs = [np.unique(g, return_counts=True) for g in grams]
    if not pairs:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate([p[0] for p in pairs]), np.concatenate([p[1] for p in pairs]), np.repeat(np.arange(len(pairs)), [len(p[0]) for p in pairs])


def similarity(a: np.ndarray, b: np.ndarray) -> tuple[int, int]:
    """Common and all occurrences of two sorted lists of shingles."""
    x, n = np.unique(a, return_counts=True)
    y, m = np.unique(b, return_counts=True)
    _, i, j = np.intersect1d(x, y, assume_unique=True, return_indices=True)
    common = int(np.minimum(n[i], m[j]).sum())
    return common, len(a) + len(b) - common


def leaks(hashes: np.ndarray, items: Items, hits: dict[int, np.ndarray]) -> Iterator[tuple[int, int, int, int]]:
    """(item's number, first word, common, all) of the best window of each item that leaks into the words of one text.

    hits: for each shingle size, the words where a known shingle starts.
    """
    wanted: dict[int, list[np.ndarray]] = {}  # by length of items, the words where a shingle of theirs starts
    for size, at in hits.items():
        grams = ngrams(hashes, size)
        order = np.argsort(grams[at], kind="stable")
        value, first = np.unique(grams[at][order], return_index=True)
        for x, own in zip(value.tolist(), np.split(at[order], first[1:]), strict=True) if len(at) else ():
            for n in items.lengths_of.get(x, ()):
                if min(SIZE, n) == size and len(hashes) >= n:
                    wanted.setdefault(int(n), []).append(own)
    best: dict[int, tuple[int, int, int, int]] = {}
    for n, parts in wanted.items():
        size = min(SIZE, n)
        grams = ngrams(hashes, size)
        a = np.concatenate(parts)
        # windows that hold one of these words begin in a stretch; stretches are counted in and out, however many there are
        inside = np.bincount(np.maximum(0, a - n + size), minlength=len(hashes) + 2) - np.bincount(np.minimum(a, len(hashes) - n) + 1, minlength=len(hashes) + 2)
        start = np.flatnonzero(np.cumsum(inside))
        seen, m = np.zeros(len(hashes) + 1, np.int64), n - size + 1
        seen[hits[size] + 1] = 1
        seen = np.cumsum(seen)
        # of m shingles each, similar windows and items have 2 S m / (100 + S) in common, so that many are known
        start = start[(100 + SIMILARITY) * (seen[start + m] - seen[start]) >= 2 * SIMILARITY * m]
        for k in range(0, len(start), 4096):
            some = start[k : k + 4096]
            each = [np.sort(grams[s : s + n - size + 1]) for s in some]
            value, weight, owner = bags(each)
            prints = fingerprints(value, weight, owner, len(some))
            for s, own, keys in zip(some.tolist(), each, blocks(prints), strict=True):
                for i in items.met(keys, n).tolist():
                    common, total = similarity(own, items.grams[i])
                    if 100 * common >= SIMILARITY * total and (i not in best or common * best[i][3] > best[i][2] * total):
                        best[i] = (i, s, common, total)
    best |= {i: (i, 0, common, total) for i, common, total in _shorter(hashes, items, hits)}
    yield from sorted(best.values())


def _shorter(hashes: np.ndarray, items: Items, hits: dict[int, np.ndarray]) -> Iterator[tuple[int, int, int]]:
    """(item's number, common, all) of each item of more words than a whole text that is similar to it; only texts of SIZE words or more can be."""
    m = len(hashes) - SIZE + 1
    # the item has at least m + 1 shingles, and the share that similarity calls for bounds them from above
    if m < 1 or (100 + SIMILARITY) * len(hits.get(SIZE, ())) < SIMILARITY * (2 * m + 1) or 100 * m < SIMILARITY * (m + 1):
        return
    own = np.sort(ngrams(hashes, SIZE))
    near, most = items.sharing(own)
    theirs = items.length[near] - SIZE + 1
    for i in near[(theirs > m) & ((100 + SIMILARITY) * most >= SIMILARITY * (m + theirs))].tolist():
        common, total = similarity(own, items.grams[i])
        if 100 * common >= SIMILARITY * total:
            yield i, common, total


def _item_blocks(benchmark: DataFrame) -> tuple[int, Callable[[int], Items]]:
    """How many blocks of about ITEM_WORDS words the benchmark has, and what makes each."""
    items = benchmark.where("item_id is not null and text is not null").select("item_id", "text")
    total = items.agg(F.sum(F.size(F.split("text", r"\s+")))).first()[0] or 0
    n = -(-total // ITEM_WORDS)

    def block(k: int) -> Items:
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k).orderBy("item_id", "text").collect()
        return Items.of([r.item_id for r in rows], [r.text for r in rows])

    return n, block


def find_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, first_word, n_words, similarity): of each item that leaks into a document, the best window."""
    schema = "doc_id long, item_id long, first_word long, n_words long, similarity double"
    n, block = _item_blocks(benchmark)
    docs = docs.select("doc_id", "text")
    if not n:
        return docs.sparkSession.createDataFrame([], schema)
    if n == 1:
        return docs.mapInArrow(_finder(docs.sparkSession, block(0))[0], schema)
    maybe = np.zeros(1 << MAYBE, bool)
    sizes: set[int] = set()
    for k in range(n):
        items = block(k)
        maybe[(items.known >> np.uint64(64 - MAYBE)).astype(np.int64)] = True
        sizes |= set(items.sizes())
    some, out = cut(docs.mapInArrow(_sharing(docs.sparkSession, np.packbits(maybe), sorted(sizes)), docs.schema)), None
    for k in range(n):
        run, shared = _finder(docs.sparkSession, block(k))
        found = cut(some.mapInArrow(run, schema))
        shared.destroy()
        out = found if out is None else out.union(found)
    return out


def _sharing(spark: SparkSession, bits: np.ndarray, sizes: list[int]):
    """Rows whose text has a shingle that is marked."""
    shared = spark.sparkContext.broadcast(bits)  # 2**MAYBE / 8 bytes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text", 4 << 20):
            w, some = words(plain(part.column(1))), np.zeros(part.num_rows, bool)
            for size in sizes:
                grams = ngrams(w.hash, size)
                at = (grams >> np.uint64(64 - MAYBE)).astype(np.int64)
                hit = np.flatnonzero(shared.value[at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1)
                some[w.row[hit[w.row[hit] == w.row[hit + size - 1]]]] = True
            yield part.filter(pa.array(some))

    return run


def _finder(spark: SparkSession, block: Items):
    shared = spark.sparkContext.broadcast(block)
    names = ["doc_id", "item_id", "first_word", "n_words", "similarity"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = shared.value
        maybe = np.zeros(1 << 20, bool)
        maybe[(items.known >> np.uint64(44)).astype(np.int64)] = True
        for part in slices(batches, "text", 4 << 20):
            w = words(plain(part.column(1)))
            bounds, hits = w.bounds(), {}
            for size in items.sizes():
                grams = ngrams(w.hash, size)
                at = np.flatnonzero(maybe[(grams >> np.uint64(44)).astype(np.int64)])
                at = at[np.isin(grams[at], items.known)]
                hits[size] = at[w.row[at] == w.row[at + size - 1]]
            rows = np.unique(np.concatenate([w.row[at] for at in hits.values()])) if hits else []
            found = []
            for r in rows:
                a, b = bounds[r], bounds[r + 1]
                own = {size: at[np.searchsorted(at, a) : np.searchsorted(at, b)] - a for size, at in hits.items()}
                for i, first, common, total in leaks(w.hash[a:b], items, own):
                    found.append((part.column(0)[int(r)].as_py(), items.ids[i], first, min(int(items.length[i]), int(b - a)), common / total))
            if found:
                kinds = [pa.int64()] * 4 + [pa.float64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*found, strict=True), kinds, strict=True)], names=names)

    return run, shared


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """docs without those that hold an item of the benchmark; rows without doc_id stay only if no such row leaks."""
    named = benchmark.withColumn("item_id", F.coalesce("item_id", F.xxhash64("text")))
    leaking = find_leaks(docs, named).select(F.col("doc_id").alias("__leak")).distinct()
    return docs.join(leaking, F.col("doc_id").eqNullSafe(F.col("__leak")), "left_anti")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
