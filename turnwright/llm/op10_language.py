"""Language ID by segmentation-marginalised unigrams over a fixed public vocabulary.

Each language has a probability for every piece, a byte string of the vocabulary. A word, with a space before it, has the probability of
all ways to cut it into pieces, summed up by the forward algorithm; a text that of its words. The pieces' probabilities are learned by
expectation maximisation with forward and backward sums over the words of labelled texts. Distinct words of a batch are scored once, for
all languages together.

All pieces and whole words take part, whatever their length. Where no piece in a word spans a place, every segmentation has a border there,
so the word's sum is the product of its parts' sums: words are cut there, which loses nothing and keeps the parts short. Parts of up to
SHORT bytes are summed together by length; longer ones alone, in logarithms, so that nothing underflows.

Only fitting is bounded: about PER_LANGUAGE texts of each language, those with the smallest hashes, and TRAIN_ROWS with TRAIN_BYTES of text in all at most. Every row
is scored, over its whole text, with equal prior odds of all languages.

Defined results: `und` and score 0 if the text is null or has no letter, or nothing was learned; ties go to the language first in order;
equal texts get equal results; a piece that holds white space never matches, as words hold none; other columns pass through, but for those
that are added, which replace namesakes.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from turnwright.llm.clusterio import crc_of_id, sample, table
from turnwright.llm.words import gather, slices, words

VOCABULARY = public_tokenizers.path("byte_bpe_50k.tiktoken")
SHORT, ROUNDS, SMOOTHING, BLOCK = 32, 3, 0.05, 1 << 14
#: Bounds of what the model is fitted on.
PER_LANGUAGE, TRAIN_ROWS, TRAIN_BYTES = 400, 4000, 64 << 20
UNDETERMINED = "und"


class Pieces:
    """The pieces of a vocabulary file of ranks, as a trie."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            self.pieces = [base64.b64decode(line.split()[0]) for line in f if line.strip()]
        nodes, piece, steps = 1, {}, {}
        for k, token in enumerate(self.pieces):
            at = 0
            for byte in token:
                step = at << 8 | byte
                if step not in steps:
                    steps[step], nodes = nodes, nodes + 1
                at = steps[step]
            piece[at] = k
        self.piece = np.full(nodes, -1, np.int32)
        self.piece[list(piece)] = list(piece.values())
        self.step = np.array(sorted(steps), np.int64)
        self.next = np.array([steps[s] for s in self.step.tolist()], np.int32)

    def matches(self, data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Where pieces begin in the strings, their lengths and numbers, by place and length."""
        last = np.repeat(ends[1:], np.diff(ends))
        at, node, length, found = np.arange(len(data)), np.zeros(len(data), np.int64), 0, []
        while len(at):
            step = node << 8 | data[at + length]
            to = np.minimum(np.searchsorted(self.step, step), len(self.step) - 1)
            on = self.step[to] == step
            at, node, length = at[on], self.next[to[on]].astype(np.int64), length + 1
            hit = self.piece[node] >= 0
            found.append((at[hit], np.full(int(hit.sum()), length), self.piece[node[hit]]))
            more = at + length < last[at]
            at, node = at[more], node[more]
        if not found:
            return (np.zeros(0, np.int64),) * 3
        start, length, piece = (np.concatenate(x) for x in zip(*found, strict=True))
        order = np.argsort(start, kind="stable")
        return start[order], length[order], piece[order]


@cache
def vocabulary(path: str) -> Pieces:
    return Pieces(path)


class Lattice:
    """The pieces in some strings, which are cut in parts where no piece crosses. owner: the string of each part."""

    def __init__(self, data: np.ndarray, ends: np.ndarray, pieces: Pieces):
        self.none = len(pieces.pieces)
        start, length, piece = pieces.matches(data, ends)
        change = np.zeros(len(data) + 2, np.int64)
        np.add.at(change, start + 1, 1)
        np.add.at(change, start + length, -1)
        free = np.cumsum(change[: len(data) + 1]) == 0
        free[ends] = True
        free[0] = free[-1] = True
        parts = np.flatnonzero(free)
        self.start, self.size = parts[:-1], np.diff(parts)
        self.owner = np.searchsorted(ends, self.start, side="right") - 1
        short = np.repeat(self.size <= SHORT, self.size)
        # of short parts, the piece of each length that begins at each byte; of long ones, lists of the pieces that end at each place
        few = short[start]
        self.piece = [np.full(len(data), self.none, np.int32) for _ in range(int(length[few].max()) if few.any() else 0)]
        for k in range(len(self.piece)):
            own = few & (length == k + 1)
            self.piece[k][start[own]] = piece[own]
        stop = (start + length)[~few]
        order = np.argsort(stop, kind="stable")
        self.stop, self.back, self.ending = stop[order], length[~few][order], piece[~few][order]
        self.uses = np.bincount(piece, minlength=self.none + 1).astype(float)

    def blocks(self) -> Iterator[tuple[np.ndarray, int]]:
        """Short parts of one length, BLOCK at most."""
        order = np.argsort(self.size, kind="stable")
        order = order[: np.searchsorted(self.size[order], SHORT, side="right")]
        edges = np.flatnonzero(np.append(True, np.append(np.diff(self.size[order]) > 0, True))) if len(order) else np.zeros(0, int)
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            for k in range(a, b, BLOCK):
                yield order[k : min(b, k + BLOCK)], int(self.size[order[a]])

    def long(self) -> Iterator[tuple[int, np.ndarray]]:
        """Long parts, and where the pieces that end at each place but the first begin among all such, with their end."""
        for k in np.flatnonzero(self.size > SHORT).tolist():
            yield k, np.searchsorted(self.stop, np.arange(self.start[k] + 1, self.start[k] + self.size[k] + 2))

    def forward(self, some: np.ndarray, length: int, p: np.ndarray) -> np.ndarray:
        """Sums of the probabilities of all segmentations of each start of the parts; p: (pieces and one of 0) x languages."""
        sums = np.zeros((length + 1, len(some), p.shape[1]))
        sums[0] = 1
        for j in range(1, length + 1):
            for k in range(1, min(j, len(self.piece)) + 1):
                at = self.piece[k - 1][self.start[some] + j - k]
                if (at != self.none).any():
                    sums[j] += sums[j - k] * p[at]
        return sums

    def logs(self, edges: np.ndarray, log_p: np.ndarray, whole: bool = False) -> np.ndarray:
        """The logarithms of such sums of one long part: its last one, kept with no more before it than the longest piece has bytes; whole: all."""
        n = len(edges) - 1
        ring = n + 1 if whole else int(self.back[edges[0] : edges[-1]].max(initial=0)) + 1
        out = np.zeros((ring, log_p.shape[1]))
        for j in range(1, n + 1):
            own = slice(edges[j - 1], edges[j])
            out[j % ring] = np.logaddexp.reduce(out[(j - self.back[own]) % ring] + log_p[self.ending[own]], axis=0)
        return out if whole else out[n % ring]

    def log_likelihood(self, p: np.ndarray, log_p: np.ndarray) -> np.ndarray:
        """Of each part, by language."""
        out = np.zeros((len(self.size), p.shape[1]))
        for some, length in self.blocks():
            out[some] = np.log(self.forward(some, length, p)[length])
        for k, edges in self.long():
            out[k] = self.logs(edges, log_p)
        return out

    def expected(self, p: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """Expected uses of each piece under probabilities p (one column), strings weighted."""
        out, weight = np.zeros(self.none + 1), weight[self.owner]
        for some, length in self.blocks():
            ahead = self.forward(some, length, p)[:, :, 0]
            behind = np.zeros_like(ahead)
            behind[length] = weight[some] / ahead[length]
            for j in range(length, 0, -1):
                for k in range(1, min(j, len(self.piece)) + 1):
                    at = self.piece[k - 1][self.start[some] + j - k]
                    use = p[at, 0] * behind[j]
                    behind[j - k] += use
                    out += np.bincount(at, use * ahead[j - k], self.none + 1)
        with np.errstate(divide="ignore"):
            log_p = np.log(p)
        for k, edges in self.long():
            ahead = self.logs(edges, log_p, whole=True)[:, 0]
            behind = np.full(len(ahead), -np.inf)
            behind[-1] = -ahead[-1]
            for j in range(len(edges) - 1, 0, -1):
                own = slice(edges[j - 1], edges[j])
                begin, piece = j - self.back[own], self.ending[own]
                use = log_p[piece, 0] + behind[j]
                behind[begin] = np.logaddexp(behind[begin], use)
                np.add.at(out, piece, weight[k] * np.exp(use + ahead[begin]))
        out[self.none] = 0
        return out


def strings(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, int]:
    """The distinct words of texts with a space before each, as bytes and ends; of each word in the texts its row and string; the rows."""
    w = words(column)
    rows = len(w.offsets) - 1
    _, first, which = np.unique(w.hash, return_index=True, return_inverse=True)
    data, ends = gather(np.append(np.uint8(0x20), w.buf), w.start[first], w.end[first] + 1)
    data[ends[:-1]] = 0x20
    return data, ends, w.row, which, rows


@dataclass
class Model:
    languages: list[str]
    log_p: np.ndarray
    path: str

    def score(self, column: pa.Array) -> tuple[list[str], np.ndarray]:
        data, ends, row, which, rows = strings(column)
        total = np.zeros((rows, len(self.languages)))
        if len(row):
            lattice = Lattice(data, ends, vocabulary(self.path))
            each = lattice.log_likelihood(np.exp(self.log_p), self.log_p)
            for k in range(len(self.languages)):
                total[:, k] = np.bincount(row, np.bincount(lattice.owner, each[:, k])[which], rows)
        odds = np.exp(total - total.max(axis=1, keepdims=True))
        best = total.argmax(axis=1)
        return [self.languages[k] for k in best], (odds[np.arange(rows), best] / odds.sum(axis=1)) if rows else np.zeros(0)


def fit(texts: dict[str, list[str]], path: str = VOCABULARY) -> Model:
    """Piece probabilities of each language from its texts."""
    pieces, names, columns = vocabulary(path), sorted(texts), []
    for name in names:
        data, ends, _, which, _ = strings(pa.array(texts[name], pa.string()))
        lattice = Lattice(data, ends, pieces)
        weight = np.bincount(which, minlength=len(ends) - 1).astype(float)
        use = lattice.uses
        for _ in range(ROUNDS + 1):
            use[-1] = 0
            p = (use + SMOOTHING) / (use.sum() + SMOOTHING * (len(use) - 1))
            p[-1] = 0
            if _ < ROUNDS:
                use = lattice.expected(p[:, None], weight)
        columns.append(p)
    with np.errstate(divide="ignore"):
        return Model(names, np.log(np.array(columns).T) if columns else np.zeros((len(pieces.pieces) + 1, 0)), path)


def learn(docs: DataFrame, per_language: int = PER_LANGUAGE, limit: int = TRAIN_ROWS, path: str = VOCABULARY) -> Model:
    """The model of a bounded sample of the labelled rows of docs whose crc32(doc_id) mod 3 isn't 1."""
    known = docs.where("doc_id is not null and lang is not null").where(crc_of_id() % 3 != 1).select("doc_id", "lang")
    sizes = known.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    share = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / float(1 << 30)
    chosen = known.join(sizes, "lang").where(share * F.col("n") <= per_language).orderBy(F.xxhash64("doc_id"), "doc_id", "lang").limit(limit)
    chosen = chosen.distinct().select(F.col("doc_id").alias("id"), F.col("lang").alias("own"))
    rows = docs.select("doc_id", "lang", "text").join(F.broadcast(chosen), (F.col("doc_id") == F.col("id")) & (F.col("lang") == F.col("own")))
    texts: dict[str, list[str]] = {}
    for r in sample(rows.withColumn("order", F.xxhash64("doc_id", "lang", "text")), ["order"], "text", limit, TRAIN_BYTES).select("lang", "text").collect():
        texts.setdefault(r.lang, []).append(r.text or "")
    return fit(texts, path)


def predict(df: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """df with lang_pred and score."""
    shared = df.sparkSession.sparkContext.broadcast(model)
    keep = [c for c in df.columns if c not in ("lang_pred", "score")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, text, 2 << 20):
            names, score = shared.value.score(part.column(part.schema.get_field_index(text)))
            yield pa.RecordBatch.from_arrays([*(part.column(part.schema.get_field_index(c)) for c in keep), pa.array(names, pa.string()), pa.array(score)], names=[*keep, "lang_pred", "score"])

    added = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    schema = T.StructType([*(df.schema[c] for c in keep), *added])
    if not model.languages:
        return df.select(*keep).withColumns({"lang_pred": F.lit(UNDETERMINED), "score": F.lit(0.0)})
    out = df.mapInArrow(run, schema)
    lettered = F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False))
    return out.withColumns({"lang_pred": F.when(lettered, F.col("lang_pred")).otherwise(UNDETERMINED), "score": F.when(lettered, F.col("score")).otherwise(0.0)})


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = predict(docs.select("doc_id", "text"), learn(docs))
    return out.select("doc_id", (crc_of_id() % 3 == 1).alias("held_out"), "lang_pred", "score")
