"""Byte-level BPE encoding and decoding with the tokenizers library over Arrow batches.

Texts are cut at single white space characters between other characters, where no match of the split pattern can
cross; each distinct cut of a batch (told by a hash, then by its bytes) is split by the pattern, written in the vocabulary's byte characters and
encoded once by the library's BPE model, and the ids are then laid out for every row. Decoding reverses the byte table token
by token, so a character that two tokens share comes back whole.

Defined results: a null or empty text has no ids and decodes to no bytes; null ids decode to null; equal rows get
equal results; other columns pass through, but for those that the operator adds, which replace namesakes.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from functools import cache
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from turnwright.llm.clusterio import table
from turnwright.llm.words import gather, range_hashes, raw, slices

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
CACHED_CUTS, CACHED_PIECES = 200_000, 100_000


def byte_characters() -> dict[int, str]:
    """The printable character that stands for each byte: itself where it is printable Latin-1, else the next from U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(0x100 + k) for k, b in enumerate(rest)}


class ByteTable:
    """The bytes of each token of a tokenizers vocabulary file of the byte-level kind."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            self.vocabulary: dict[str, int] = json.load(f)["model"]["vocab"]
        back = {c: b for b, c in byte_characters().items()}
        tokens = [b""] * (max(self.vocabulary.values()) + 1)
        for token, i in self.vocabulary.items():
            tokens[i] = bytes(back[c] for c in token) if all(c in back for c in token) else token.encode()
        self.token_bytes = np.frombuffer(b"".join(tokens), np.uint8)
        self.token_ends = np.cumsum([0, *map(len, tokens)])

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of all rows, and of each row where they start."""
        data, ends = gather(self.token_bytes, self.token_ends[ids], self.token_ends[ids + 1])
        return data, ends[offsets]


class ByteBpe(ByteTable):
    """An encoder with such a vocabulary and its merges."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer, models

        super().__init__(path)
        with open(path, encoding="utf-8") as f:
            merges = json.load(f)["model"]["merges"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in merges]
        self.model = Tokenizer(models.BPE(self.vocabulary, merges, cache_capacity=0))
        self.pattern = regex.compile(public_tokenizers.PATTERN)
        self.written = {ord(chr(b)): c for b, c in byte_characters().items()}
        self._forget()

    def _forget(self, but: list[bytes] = ()) -> None:
        """An empty cache, but for some known cuts."""
        if but:
            but = list(dict.fromkeys(but))
            at, ends = np.array([self.known[h] for h in but]), np.array(self.store_ends)
            ids, ends = gather(self.store, ends[at], ends[at + 1])
            self.known, self.store, self.store_ends = {h: k for k, h in enumerate(but)}, ids, ends.tolist()
        else:
            self.known, self.store, self.store_ends = {}, np.zeros(0, np.int32), [0]
            self.pieces: dict[str, list[int]] = {}

    def _learn(self, cuts: list[bytes]) -> None:
        cuts = list(dict.fromkeys(cuts))
        pieces = [self.pattern.findall(t.decode()) for t in cuts]
        distinct = list(dict.fromkeys(chain.from_iterable(pieces)))
        if len(self.pieces) + len(distinct) > CACHED_PIECES:
            self.pieces = {p: self.pieces[p] for p in distinct if p in self.pieces}
        ids, new = self.pieces, [p for p in distinct if p not in self.pieces]
        for k in range(0, len(new), 4096):
            part = new[k : k + 4096]
            mapped = [p.encode().decode("latin-1").translate(self.written) for p in part]
            ids.update(zip(part, (e.ids for e in self.model.encode_batch_fast(mapped, add_special_tokens=False)), strict=True))
        flat, base, count = [], self.store_ends[-1], len(self.store_ends) - 1
        ends = self.store_ends
        for own in pieces:
            for p in own:
                flat += ids[p]
            ends.append(base + len(flat))
        self.known.update(zip(cuts, range(count, count + len(cuts)), strict=True))
        self.store = np.concatenate([self.store[:base], np.array(flat, np.int32)])

    @staticmethod
    def cuts(buf: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Positions where a row starts, or the pattern's matches surely end, as one white space stands between two other characters."""
        n = len(buf)
        if not n:
            return np.zeros(1, np.int64)
        edge = np.zeros(n + 1, bool)
        edge[offsets] = True
        at = np.flatnonzero((buf == 0x20) | ((buf >= 0x09) & (buf <= 0x0D)))
        at = at[(at >= 1) & (at < n - 1)]
        before, after = buf[at - 1], buf[at + 1]
        # Unicode's other white space starts with one of these bytes; a cut beside any character that does is left out
        lead = np.isin(np.arange(256), [0xC2, 0xE1, 0xE2, 0xE3])
        good = (before > 0x20) & (after > 0x20) & ~lead[after] & ~edge[at] & ~edge[at + 1]
        good &= (before < 0x80) | ~(lead[buf[np.maximum(at - 2, 0)]] | lead[buf[np.maximum(at - 3, 0)]])
        at = at[good]
        edge[at] = True
        edge[at[buf[at] != 0x20] + 1] = True
        return np.flatnonzero(edge)

    @staticmethod
    def distinct(buf: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distinct cuts, each by its first place, and of every cut its number among them. Cuts with equal hashes count as equal only if their bytes are."""
        _, first, inverse = np.unique(range_hashes(buf, cuts), return_index=True, return_inverse=True)
        size = np.diff(cuts)
        same = size[first][inverse] == size
        like = np.where(same, first[inverse], np.arange(len(size)))
        copy, _ = gather(buf, cuts[like], cuts[like + 1])
        at = np.searchsorted(cuts, np.flatnonzero(copy != buf[: cuts[-1]]), side="right") - 1
        same[at] = False
        alone = np.flatnonzero(~same)
        inverse[alone] = len(first) + np.arange(len(alone))
        return np.append(first, alone), inverse

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all rows, and of each row where they start."""
        buf, offsets = raw(column)
        cuts = self.cuts(buf, offsets)
        first, inverse = self.distinct(buf, cuts)
        data = buf.tobytes()
        keys = [data[a:b] for a, b in zip(cuts[first].tolist(), cuts[first + 1].tolist(), strict=True)] if len(first) else []
        if len(self.known) + len(keys) > CACHED_CUTS:
            self._forget([k for k in keys if k in self.known])
        self._learn([k for k in keys if k not in self.known])
        where = np.fromiter(map(self.known.__getitem__, keys), np.int64, len(keys))[inverse]
        ends = np.array(self.store_ends)
        ids, ends = gather(self.store, ends[where], ends[where + 1])
        return ids, ends[np.searchsorted(cuts, offsets)] if len(cuts) > 1 else np.zeros(len(offsets), np.int64)

    def spans(self, column: pa.Array, ids: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of each id, the characters of its row that it touches: the first, and the one after the last."""
        buf, rows = raw(column)
        size = self.token_ends[ids + 1] - self.token_ends[ids]
        end = np.cumsum(size)
        chars = np.concatenate([[0], np.cumsum((buf & 0xC0) != 0x80)])
        own = np.repeat(chars[rows[:-1]], np.diff(offsets))
        return (chars[end - size + 1] - 1 - own).astype(np.int32), (chars[end] - own).astype(np.int32)


@cache
def encoder(path: str) -> ByteBpe:
    return ByteBpe(path)


@cache
def decoder(path: str) -> ByteTable:
    return ByteTable(path)


def _parts(batch: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    """The batch in pieces of one row at least, and at most a megabyte of text or half a million ids."""
    at = batch.schema.get_field_index(column)
    if pa.types.is_list(batch.schema.field(at).type):
        ends, done = np.cumsum(np.asarray(pc.list_value_length(batch.column(at)).fill_null(0))), 0
        while done < batch.num_rows:
            to = max(done + 1, int(np.searchsorted(ends, (ends[done - 1] if done else 0) + 500_000, side="right")))
            yield batch.slice(done, to - done)
            done = to
    else:
        yield from slices(iter([batch]), column, 1 << 20)


def _with(df: DataFrame, add: list[T.StructField], column: str, work: Callable[[pa.Array], list[pa.Array]]) -> DataFrame:
    """df with columns that work makes of one column, batch by batch."""
    names = {f.name for f in add}
    keep = [c for c in df.columns if c not in names]
    schema = T.StructType([*(f for f in df.schema.fields if f.name in keep), *add])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _parts(batch, column):
                got = work(part.column(part.schema.get_field_index(column)))
                yield pa.RecordBatch.from_arrays([*(part.column(part.schema.get_field_index(c)) for c in keep), *got], names=[*keep, *(f.name for f in add)])

    return df.mapInArrow(run, schema)


def encode(df: DataFrame, text: str = "text", ids: str = "ids", spans: bool = False, path: str = VOCABULARY) -> DataFrame:
    """df with the ids of each text; spans: also the characters that each id touches, as starts and ends."""

    def work(column: pa.Array) -> list[pa.Array]:
        own = encoder(path)
        got, offsets = own.encode(column)
        rows = pa.array(offsets.astype(np.int32))
        return [pa.ListArray.from_arrays(rows, pa.array(x)) for x in (got, *(own.spans(column, got, offsets) if spans else ()))]

    kind = T.ArrayType(T.IntegerType(), False)
    return _with(df, [T.StructField(c, kind) for c in ([ids, "starts", "ends"] if spans else [ids])], text, work)


def decode(df: DataFrame, ids: str = "ids", decoded: str = "decoded", path: str = VOCABULARY) -> DataFrame:
    """df with the bytes that each row's ids stand for."""

    def work(column: pa.Array) -> list[pa.Array]:
        flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        offsets = np.concatenate([[0], np.cumsum(np.asarray(pc.list_value_length(column).fill_null(0)))])
        data, ends = decoder(path).decode(flat, offsets)
        out = pa.Array.from_buffers(pa.binary(), len(column), [None, pa.py_buffer(ends.astype(np.int32).tobytes()), pa.py_buffer(data.tobytes())])
        return [pc.if_else(column.is_valid(), out, pa.scalar(None, pa.binary()))] if column.null_count else [out]

    return _with(df, [T.StructField(decoded, T.BinaryType())], ids, work)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document, encoded and decoded again; digests of both."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    both = decode(encode(docs).drop("text"))
    return both.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


