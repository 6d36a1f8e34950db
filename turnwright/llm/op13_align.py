"""Alignment of two tokenizers over a corpus: where tokens of both end together, which tokens overlap, and how often each pair of ids does.

Side A is a byte-level BPE of the tokenizers library, side B a sentencepiece model. Both see a space and then the text. No token of either crosses
a place where one space or line end stands between two other characters, so a text is cut there, and a cut's tokens, groups and links are worked out
once for all its repeats in a task. Documents give postings (how often they link each pair of ids), which are written once. Counts of pairs are summed from
them, as is the highest of each B id; then the postings are shuffled by their ids and merged, as two sorted streams that spill, with the counts,
and what each document gets from its pairs is summed by document. Dealing by both ids and not by B's alone spreads a B id that most postings hold; a
pair that most postings hold is split by adaptive execution.

Defined results: a null or empty text, and one whose A or B tokens don't spell a space and the text (say, one with U+2581), have no tokens: zeros, and no groups. Every row
counts, those that repeat another row or a doc_id too; a null doc_id stays null. Other columns are left out. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from functools import cache
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from turnwright.llm.clusterio import table
from turnwright.llm.op1_bpe import ByteBpe, ByteTable
from turnwright.llm.words import gather, raw, slices
from turnwright.session import scratch

SIDE_A, SIDE_B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
CACHED_CUTS = 300_000
#: Bytes of text in a piece of work, pairs in a row of postings, cuts hashed at once.
PIECE, POSTINGS, HASHED = 1 << 20, 1 << 14, 1 << 12
#: Added to a serialized model it says: normalizer_spec { add_dummy_prefix: false }, as cuts bring their own spaces.
_NO_PREFIX = b"\x1a\x02\x18\x00"
_SCHEMA = "rid long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, b array<int>, a array<int>, m array<int>"


class Pieces:
    """A sentencepiece model without a prefix of its own, and the bytes of its pieces."""

    def __init__(self, path: str):
        import sentencepiece

        with open(path, "rb") as f:
            self.model = sentencepiece.SentencePieceProcessor(model_proto=f.read() + _NO_PREFIX)
        names = [self.model.id_to_piece(i) for i in range(self.model.vocab_size())]
        spelt = [bytes([int(p[3:-1], 16)]) if self.model.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(names)]
        self.token_bytes = np.frombuffer(b"".join(spelt), np.uint8)
        self.token_ends = np.cumsum([0, *map(len, spelt)])
        words = [p for i, p in enumerate(names) if not self.model.is_byte(i)]
        #: Where texts may be cut: at spaces if no piece has one after another character, at line ends if no piece has one.
        self.breaks = [0x20] * all("▁" not in p.lstrip("▁") for p in words) + [0x0A] * all("\n" not in p for p in words)


def _flat(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.fromiter(map(len, lists), np.int64, len(lists))
    return np.fromiter(chain.from_iterable(lists), np.int64, int(sizes.sum())), np.concatenate([[0], np.cumsum(sizes)])


#: Decimal numbers up to a tokenizer's ids, each with a comma, and where they start.
_DECIMALS = b"".join(b"%d," % k for k in range(1 << 17))
_DECIMAL_BYTES, _DECIMAL_ENDS = np.frombuffer(_DECIMALS, np.uint8), np.append(0, np.flatnonzero(np.frombuffer(_DECIMALS, np.uint8) == ord(",")) + 1)


def _written(ids_a: np.ndarray, ids_b: np.ndarray, group_a: np.ndarray, group_b: np.ndarray) -> tuple[bytes, np.ndarray]:
    """Groups in order as text, each with its A ids, a bar, its B ids and a semicolon; and of each group where it starts."""
    group = np.concatenate([group_a, group_b])
    order = np.argsort(group, kind="stable")  # of equal groups A's come first
    group, ids = group[order], np.concatenate([ids_a, ids_b])[order]
    of_b = order >= len(ids_a)
    text, ends = gather(_DECIMAL_BYTES, _DECIMAL_ENDS[ids], _DECIMAL_ENDS[ids + 1])
    last = np.append(group[1:] != group[:-1], True)[: len(group)]
    bar = np.append(of_b[1:] & ~of_b[:-1] & ~last[:-1], False)[: len(group)]
    text[ends[1:][last] - 1] = ord(";")
    text[ends[1:][bar] - 1] = ord("|")
    return text.tobytes(), np.append(0, ends[1:][last])


class Aligner:
    """Tokens, groups and links of texts, cut by cut, with a cache of cuts."""

    def __init__(self, path_a: str, path_b: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks are as many as cores
        self.a, self.b = ByteTable(path_a), Pieces(path_b)
        self.encoder = Tokenizer.from_file(path_a)
        self.encoder.encode_special_tokens = True
        self._forget()

    def _forget(self) -> None:
        """Nothing is known."""
        self.known: dict[bytes, int] = {}
        self.groups: list[bytes] = []
        self.numbers: dict[int, int] = {}  # of pairs
        self.counts = np.zeros((0, 5), np.int64)  # of a cut: A tokens, B tokens, groups, links, whether both sides spell it
        self.pairs, self.ends = np.zeros(0, np.int64), np.zeros(1, np.int64)
        self.used = np.zeros(0, np.int64)

    def _tidy(self) -> None:
        """Keep a third of what may be known, the cuts used most; their use counts half from now on."""
        at = np.sort(np.argsort(-self.used, kind="stable")[: CACHED_CUTS // 3])
        cuts = list(self.known)
        self.known = {cuts[k]: i for i, k in enumerate(at.tolist())}
        self.groups = [self.groups[k] for k in at.tolist()]
        self.pairs, self.ends = gather(self.pairs, self.ends[at], self.ends[at + 1])
        self.counts, self.used = self.counts[at], self.used[at] // 2

    def _learn(self, cuts: list[bytes]) -> None:
        texts = [c.decode() for c in cuts]
        ids_a, rows_a = _flat([e.ids for e in self.encoder.encode_batch_fast(texts, add_special_tokens=False)])
        ids_b, rows_b = _flat(self.b.model.encode(texts, num_threads=1))
        want, edges = np.frombuffer(b"".join(cuts), np.uint8), np.concatenate([[0], np.cumsum([len(c) for c in cuts])])
        good = np.ones(len(cuts), bool)
        for side, ids, rows in ((self.a, ids_a, rows_a), (self.b, ids_b, rows_b)):
            got, ends = gather(side.token_bytes, side.token_ends[ids], side.token_ends[ids + 1])
            same = np.diff(ends[rows]) == np.diff(edges)
            if same.all():
                at = np.searchsorted(edges, np.flatnonzero(got != want), side="right") - 1
                same[at] = False
            else:  # bytes of the cuts whose lengths agree, beside those that they should be
                x, places = gather(got, ends[rows][:-1][same], ends[rows][1:][same])
                y, _ = gather(want, edges[:-1][same], edges[1:][same])
                same[np.flatnonzero(same)[np.searchsorted(places, np.flatnonzero(x != y), side="right") - 1]] = False
            good &= same
        keep_a, keep_b = np.repeat(good, np.diff(rows_a)), np.repeat(good, np.diff(rows_b))
        n_a, n_b = np.diff(rows_a) * good, np.diff(rows_b) * good
        ids_a, ids_b = ids_a[keep_a], ids_b[keep_b]
        ends_a = np.cumsum(self.a.token_ends[ids_a + 1] - self.a.token_ends[ids_a])
        ends_b = np.cumsum(self.b.token_ends[ids_b + 1] - self.b.token_ends[ids_b])
        cut_a = np.repeat(np.arange(len(cuts)), n_a)
        # between neighbouring ends of either side lies what one token of A shares with one of B
        ends = np.sort(np.concatenate([ends_a, ends_b]), kind="stable")
        fresh = np.append(True, ends[1:] != ends[:-1])[: len(ends)]
        common, ends = ends[~fresh], ends[fresh]
        link_a, link_b = np.searchsorted(ends_a, ends), np.searchsorted(ends_b, ends)
        n_groups, n_links = np.bincount(cut_a[np.searchsorted(ends_a, common)], minlength=len(cuts)), np.bincount(cut_a[link_a], minlength=len(cuts))
        keys, which = np.unique(ids_b[link_b] << 32 | ids_a[link_a], return_inverse=True)
        numbers = self.numbers
        pairs = np.fromiter((numbers.setdefault(k, len(numbers)) for k in keys.tolist()), np.int64, len(keys))[which]
        text, starts = _written(ids_a, ids_b, np.searchsorted(common, ends_a), np.searchsorted(common, ends_b))
        starts = starts[np.concatenate([[0], np.cumsum(n_groups)])].tolist()
        self.groups += [text[x:y] for x, y in zip(starts[:-1], starts[1:], strict=True)]
        first = len(self.known)
        self.known.update(zip(cuts, range(first, first + len(cuts)), strict=True))
        self.counts = np.concatenate([self.counts, np.stack([n_a, n_b, n_groups, n_links, good], axis=1)])
        self.pairs = np.concatenate([self.pairs, pairs])
        self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(n_links)])
        self.used = np.append(self.used, np.zeros(len(cuts), np.int64))

    def cuts(self, buf: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Positions that no token of either side crosses: rows' ends, and places beside single white space that both allow."""
        if not self.b.breaks:
            return np.unique(offsets)
        at = ByteBpe.cuts(buf, offsets)
        white = np.isin(np.arange(256), [c for c in (0x20, *range(0x09, 0x0E)) if c not in self.b.breaks])
        inner = (at > 0) & (at < len(buf))
        bad = np.zeros(len(at), bool)
        bad[inner] = white[buf[at[inner]]] | white[buf[at[inner] - 1]]
        return np.union1d(at[~bad], offsets)

    def align(self, column: pa.Array) -> tuple[np.ndarray, list[str], list[tuple[np.ndarray, np.ndarray]]]:
        """Of each text: numbers of A tokens, B tokens, groups and links; the digest of its groups; its pairs (b << 32 | a) and how often it links them."""
        rows = len(column)
        empty = np.asarray(pc.equal(pc.fill_null(pc.binary_length(column), 0), 0))
        buf, offsets = raw(pc.binary_join_element_wise(pa.scalar(" ", pa.large_string()), pc.fill_null(column, "").cast(pa.large_string()), pa.scalar("", pa.large_string())))
        cuts = self.cuts(buf, offsets)
        first, inverse = ByteBpe.distinct(buf, cuts)
        data = buf.tobytes()
        keys = [data[x:y] for x, y in zip(cuts[first].tolist(), cuts[first + 1].tolist(), strict=True)]
        if len(self.known) + len(keys) > CACHED_CUTS:
            self._tidy()
        if new := list(dict.fromkeys(k for k in keys if k not in self.known)):
            self._learn(new)
        where = np.fromiter(map(self.known.__getitem__, keys), np.int64, len(keys))[inverse]
        self.used += np.bincount(where, minlength=len(self.used))
        bounds = np.searchsorted(cuts, offsets)
        total = np.concatenate([np.zeros((1, 5), np.int64), np.cumsum(self.counts[where], axis=0)])
        numbers = total[bounds[1:]] - total[bounds[:-1]]
        live = (numbers[:, 4] == np.diff(bounds)) & ~empty
        numbers = numbers[:, :4] * live[:, None]
        digests, by_number = [""] * rows, np.fromiter(self.numbers, np.int64, len(self.numbers))
        pairs, ends = gather(self.pairs, self.ends[where], self.ends[where + 1])
        ends = ends[bounds]
        row = np.repeat(np.arange(rows), np.diff(ends))
        kept = live[row]
        found, often = np.unique(row[kept] * len(by_number) + pairs[kept], return_counts=True) if len(by_number) else (np.zeros(0, np.int64),) * 2
        places = np.searchsorted(found, np.arange(rows + 1) * len(by_number))
        found = by_number[found % max(len(by_number), 1)] if len(found) else found
        for k in np.flatnonzero(live).tolist():
            digest, own = hashlib.sha256(), where[bounds[k] : bounds[k + 1]].tolist()
            for at in range(0, len(own), HASHED):
                digest.update(b"".join([self.groups[i] for i in own[at : at + HASHED]])[: -1 if at + HASHED >= len(own) else None])
            digests[k] = digest.hexdigest()
        return numbers, digests, [(found[x:y], often[x:y]) for x, y in zip(places[:-1].tolist(), places[1:].tolist(), strict=True)]


@cache
def aligner(path_a: str, path_b: str) -> Aligner:
    return Aligner(path_a, path_b)


def _pack(batch: pa.RecordBatch, own: Aligner, schema: pa.Schema) -> pa.RecordBatch:
    """A row for each text, with its first postings, and more rows for the rest of them."""
    numbers, digests, pairs = own.align(batch.column("text"))
    ids, docs = batch.column("rid").to_pylist(), batch.column("doc_id").to_pylist()
    rows, starts, ends = [], [], []
    at = 0
    for k, (found, _) in enumerate(pairs):
        for start in range(0, max(len(found), 1), POSTINGS):
            rows.append(k if start == 0 else -k - 1)
            starts.append(at + start)
            ends.append(at + min(start + POSTINGS, len(found)))
        at += len(found)
    head = [k if k >= 0 else None for k in rows]
    offsets = pa.array([*starts, at], pa.int32())
    keys = np.concatenate([x for x, _ in pairs]) if pairs else np.zeros(0, np.int64)
    often = np.concatenate([m for _, m in pairs]) if pairs else keys
    lists = [pa.ListArray.from_arrays(offsets, pa.array(x.astype(np.int32))) for x in (keys >> 32, keys & 0xFFFFFFFF, often)]
    columns = [pa.array([ids[k if k >= 0 else -k - 1] for k in rows], pa.int64()), pa.array([docs[k] if k is not None else None for k in head], pa.int64())]
    columns += [pa.array([int(numbers[k, j]) if k is not None else None for k in head], pa.int64()) for j in range(4)]
    columns += [pa.array([digests[k] if k is not None else None for k in head], pa.string()), *lists]
    return pa.RecordBatch.from_arrays(columns, schema=schema)


def postings(docs: DataFrame, path_a: str = SIDE_A, path_b: str = SIDE_B) -> DataFrame:
    """Of each document, a row with its numbers, and its pairs b, a with their multiplicities m, the rest of long lists in rows of their own."""
    schema = pa.schema([("rid", pa.int64()), ("doc_id", pa.int64()), *((c, pa.int64()) for c in ("n_a", "n_b", "n_groups", "n_links")), ("groups_sha256", pa.string()), *((c, pa.list_(pa.int32())) for c in "bam")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = aligner(path_a, path_b)
        for part in slices(batches, "text", PIECE):
            yield _pack(part, own, schema)

    named = docs.select(F.monotonically_increasing_id().alias("rid"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return named.mapInArrow(run, T._parse_datatype_string(_SCHEMA))


def pair_counts(posted: DataFrame) -> DataFrame:
    """Of each pair of ids: how many links hold it, and whether no other pair of its B id has more. posted: rows of b, a, m."""
    counts = posted.groupBy("b", "a").agg(F.sum("m").alias("links"))
    highest = counts.groupBy("b").agg(F.max("links").alias("most"))  # a row for each id of B's vocabulary at most
    return counts.join(F.broadcast(highest), "b").select("b", "a", "links", (F.col("links") == F.col("most")).alias("best"))


def align(docs: DataFrame, path_a: str = SIDE_A, path_b: str = SIDE_B) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 of each document."""
    spark = docs.sparkSession

    def kept(df: DataFrame) -> DataFrame:
        path = scratch(spark)
        df.write.option("compression", "zstd").parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    rows = kept(postings(docs, path_a, path_b))
    posted = rows.select("rid", F.inline(F.arrays_zip("b", "a", "m")))
    counts = kept(pair_counts(posted.drop("rid")))
    gained = posted.join(counts.hint("merge"), ["b", "a"]).groupBy("rid").agg(F.sum(F.when(F.col("best"), F.col("m")).otherwise(0)).alias("n_best"), F.sum(F.col("m") * F.col("links")).alias("count_sum"))
    of_docs = rows.where(F.col("groups_sha256").isNotNull()).drop("b", "a", "m")
    nothing = F.lit(0).cast("long")
    return of_docs.join(gained, "rid", "left").select("doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", nothing).alias("n_best"), F.coalesce("count_sum", nothing).alias("count_sum"), "groups_sha256")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document."""
    return align(table(spark, sf_dir, "documents"))
