"""Words, word hashes and n-gram hashes of Arrow text columns, computed on whole buffers.

A word is a maximal run of bytes other than 0x20 and 0x09-0x0D, so all functions see whole texts, whatever
their length: a column is read in segments of about a megabyte that end at a word's end, which bounds memory.
Equal words have equal 64-bit hashes in every task and run. A hash takes in eight bytes at a time and mixes after each, so no pattern of
letters makes it collide by construction; unequal words then collide as random numbers do. It isn't made to withstand an adversary who
searches for collisions. Where 64 bits are too few, a second, unrelated hash of the same bytes is at hand.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash

SEGMENT, LONG = 1 << 20, 512
_STEP = np.uint64(0xD1342543DE82EF95)
#: What the two hashes of a word begin with.
_SEEDS = (0x9E3779B97F4A7C15, 0xA0761D6478BD642F)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_MASK = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit over the others."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def hash_ranges(buf: np.ndarray, start: np.ndarray, end: np.ndarray, which: int = 0) -> np.ndarray:
    """A hash of each range of bytes, mixed in eight bytes at a time; eight bytes must follow the last range. which: 0 or 1, two unrelated hashes."""
    size = end - start
    out = mix(size.astype(np.uint64) * _STEP + np.uint64(_SEEDS[which]))
    eights = np.ndarray(max(len(buf) - 7, 0), "<u8", buf, strides=(1,))
    some, at = np.flatnonzero((size > 0) & (size <= LONG)), 0
    while len(some):
        left = size[some] - at
        chunk = eights[start[some] + at] & _MASK[np.minimum(left, 8)]
        out[some] = mix(out[some] ^ chunk)
        some, at = some[left > 8], at + 8
    for k in np.flatnonzero(size > LONG).tolist():
        out[k] = xxhash.xxh3_64_intdigest(buf[start[k] : end[k]].tobytes(), _SEEDS[which])
    return out


@dataclass
class Words:
    """Words of the rows of one column, in order; start and end are byte positions in buf."""

    buf: np.ndarray
    offsets: np.ndarray
    start: np.ndarray
    end: np.ndarray
    row: np.ndarray
    hash: np.ndarray
    other: np.ndarray

    def bounds(self) -> np.ndarray:
        """Of each row, the index of its first word; at last, the number of words."""
        return np.searchsorted(self.row, np.arange(len(self.offsets)))


def raw(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """A text column's bytes and row offsets; null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    data = column.buffers()[2]
    buf = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return buf[offsets[0] : offsets[-1]], offsets - offsets[0]


def words(column: pa.Array | pa.ChunkedArray, lower: bool = False, hashes: int = 1) -> Words:
    """The words of each row. lower: hash A-Z as a-z. hashes: how many of the two hashes are wanted."""
    buf, offsets = raw(column)
    starts, ends, found, at = [], [], [[], []], 0
    edge = np.zeros(len(buf) + 1, bool)
    edge[offsets] = True
    while at < len(buf):
        stop = min(len(buf), at + SEGMENT)
        while stop < len(buf) and not edge[stop] and not _SPACE[buf[stop]]:
            stop += 1
        part, cut = buf[at:stop], edge[at : stop + 1]
        ink = ~_SPACE[part]
        before, after = cut[:-1].copy(), cut[1:].copy()
        before[0] = after[-1] = True
        before[1:] |= ~ink[:-1]
        after[:-1] |= ~ink[1:]
        s, e = np.flatnonzero(ink & before), np.flatnonzero(ink & after) + 1
        if hashes:
            padded = np.append(_LOWER[part] if lower else part, np.zeros(8, np.uint8))
            for which in range(hashes):
                found[which].append(hash_ranges(padded, s, e, which))
        starts.append(s + at)
        ends.append(e + at)
        at = stop
    none, unhashed = np.zeros(0, np.int64), np.zeros(0, np.uint64)
    start = np.concatenate(starts) if starts else none
    row = np.searchsorted(offsets[1:], start, side="right")
    return Words(buf, offsets, start, np.concatenate(ends) if ends else none, row, *(np.concatenate(x) if x else unhashed for x in found))


def range_hashes(buf: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """A hash of each range of bytes between neighbouring cuts, which rise from 0 to the buffer's end."""
    out, k = np.zeros(max(len(cuts) - 1, 0), np.uint64), 0
    while k < len(cuts) - 1:
        to = max(k + 1, int(np.searchsorted(cuts, cuts[k] + SEGMENT, side="right")) - 1)
        at = int(cuts[k])
        padded = np.append(buf[at : int(cuts[to])], np.zeros(8, np.uint8))
        out[k:to] = hash_ranges(padded, cuts[k:to] - at, cuts[k + 1 : to + 1] - at)
        k = to
    return out


def ngrams(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash of each run of size words, at the run's first word; the last size - 1 places are cut off."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out, done, power, width = None, 0, hashes, 1
    while True:
        if size & width:
            out = power[:n].copy() if out is None else mix(out * _STEP + power[done : done + n])
            done += width
        if (width << 1) > size:
            return mix(out + np.uint64(size))
        power = mix(power[: len(power) - width] * _STEP + power[width:])
        width <<= 1


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The batches, cut into pieces of at most limit bytes of text, or one row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, offsets = raw(batch.column(batch.schema.get_field_index(column)))
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1)
            yield batch.slice(at, to - at)
            at = to


def gather(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of the given ranges, one after the other, and their offsets."""
    size = end - start
    offsets = np.zeros(len(size) + 1, np.int64)
    np.cumsum(size, out=offsets[1:])
    at = np.arange(offsets[-1], dtype=np.int64) + np.repeat(start - offsets[:-1], size)
    return buf[at], offsets
