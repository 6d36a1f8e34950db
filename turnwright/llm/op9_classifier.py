"""Quality classifier: supervised subword embeddings, trained by stochastic gradient descent in numpy.

A text's units are its words, its pairs of neighbouring words, and a mark for each word that repeats the one before and each run of four
words that the text has had before. A word's vector is the mean of the vectors of its hashed word and hashed character n-grams (of 3
to 5 bytes, with marks at both ends); a pair's and a mark's are their own. The mean of the units' vectors goes through a softmax layer.
As both layers are linear, scoring adds up one learned number a bucket, so a task holds one table of BUCKETS numbers.

Only fitting is bounded: by at most TRAIN_ROWS labelled rows with TRAIN_BYTES of text in all, those with the smallest hashes. Every row is scored, over its whole text.

Defined results: a null or empty text has no unit and gets the score of the learned bias; equal texts get equal scores; without any row to
learn from all scores are 0.5; labels of rows without a document, or without a label, are left out; of a doc_id with several labels each is
learned; other columns pass through, but for those that are added, which replace namesakes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from turnwright.llm.clusterio import crc_of_id, sample, table
from turnwright.llm.words import Words, gather, mix, ngrams, slices, words

BUCKETS, WIDTH, EPOCHS, RATE = 1 << 18, 12, 6, 0.15
#: Bounds of what the classifier is fitted on.
TRAIN_ROWS, TRAIN_BYTES = 4000, 64 << 20
REJECT_BELOW = 0.3
_STUTTER, _AGAIN = 0, 1


def _bucket(h: np.ndarray) -> np.ndarray:
    return (h % np.uint64(BUCKETS - 2)).astype(np.int64) + 2


@dataclass
class Units:
    """The units of some texts: of each, its text and its place among the distinct units; of those, their features."""

    row: np.ndarray
    unit: np.ndarray
    of: np.ndarray
    feature: np.ndarray
    share: np.ndarray


def units(w: Words) -> Units:
    _, first, word = np.unique(w.hash, return_index=True, return_inverse=True)
    n = len(first)
    marked, ends = gather(np.concatenate([[0x3C], w.buf, [0x3E]]).astype(np.uint8), w.start[first], w.end[first] + 2)
    marked[ends[:-1]], marked[ends[1:] - 1] = 0x3C, 0x3E
    owner = np.repeat(np.arange(n), np.diff(ends))
    letters = mix(marked.astype(np.uint64) + np.uint64(0xB17E))
    of, feature = [np.arange(n)], [_bucket(mix(w.hash[first]))]
    for size in (3, 4, 5):
        if len(owner) >= size:
            inside = owner[: len(owner) - size + 1] == owner[size - 1 :]
            of.append(owner[: len(inside)][inside])
            feature.append(_bucket(ngrams(letters, size)[inside]))
    joined = np.flatnonzero(w.row[1:] == w.row[:-1])
    stutter = w.hash[joined] == w.hash[joined + 1]
    runs = np.flatnonzero(w.row[: max(len(w.row) - 3, 0)] == w.row[3:])
    told = mix(ngrams(w.hash, 4)[runs] ^ mix(w.row[runs].astype(np.uint64)))
    again = np.ones(len(runs), bool)
    again[np.unique(told, return_index=True)[1]] = False
    pair, pairs = np.unique(ngrams(w.hash, 2)[joined], return_inverse=True)
    of.append(n + np.arange(len(pair) + 2))
    feature.append(np.concatenate([[_STUTTER, _AGAIN], _bucket(pair)]))
    of, feature = np.concatenate(of), np.concatenate(feature)
    share = 1.0 / np.bincount(of, minlength=n + 2 + len(pair))[of]
    row = np.concatenate([w.row, w.row[joined], w.row[joined[stutter]], w.row[runs[again]]])
    unit = np.concatenate([word, n + 2 + pairs, np.full(stutter.sum(), n), np.full(again.sum(), n + 1)])
    return Units(row, unit, of, feature, share)


@dataclass
class Model:
    """Of each bucket, what it adds to the log odds of label 1; and the bias."""

    weight: np.ndarray
    bias: float

    def score(self, column: pa.Array) -> np.ndarray:
        w = words(column)
        rows = len(w.offsets) - 1
        total, count = np.zeros(rows), np.zeros(rows)
        if len(w.row):
            u = units(w)
            value = np.bincount(u.of, self.weight[u.feature] * u.share)
            total, count = np.bincount(u.row, value[u.unit], rows), np.bincount(u.row, minlength=rows)
        return 1.0 / (1.0 + np.exp(-np.clip(total / np.maximum(count, 1) + self.bias, -50, 50)))


def features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """A text's buckets and their shares in its mean."""
    w = words(pa.array([text], pa.string()))
    if not len(w.row):
        return np.zeros(0, np.int64), np.zeros(0)
    u = units(w)
    times = np.bincount(u.unit, minlength=u.of.max() + 1)[u.of] * u.share
    bucket, place = np.unique(u.feature, return_inverse=True)
    share = np.bincount(place, times) / len(u.unit)
    return bucket[share > 0], share[share > 0]


def fit(texts: list[str], labels: list[int], seed: int = 1) -> Model:
    """Embeddings of WIDTH numbers a bucket, and a softmax layer over two labels; steps shrink with the squares of past gradients."""
    draw = np.random.default_rng(seed)
    vectors = draw.uniform(-1 / WIDTH, 1 / WIDTH, (BUCKETS, WIDTH)).astype(np.float32)
    past = np.full(BUCKETS, 1e-8, np.float32)
    layer, bias = draw.normal(0, 1, (2, WIDTH)).astype(np.float32), np.zeros(2, np.float32)
    bags = [(bucket.astype(np.int32), share.astype(np.float32)) for bucket, share in map(features, texts)]
    for epoch in range(EPOCHS):
        rate = RATE * (1 - epoch / EPOCHS)
        for k in draw.permutation(len(bags)):
            bucket, share = bags[k]
            hidden = share @ vectors[bucket] if len(bucket) else np.zeros(WIDTH, np.float32)
            logits = layer @ hidden + bias
            error = np.exp(logits - logits.max())
            error /= error.sum()
            error[labels[k]] -= 1
            back = error @ layer
            layer -= rate * np.outer(error, hidden)
            bias -= rate * 0.1 * error
            if len(bucket):
                past[bucket] += share * share * (back @ back) / WIDTH
                vectors[bucket] -= (rate * share / np.sqrt(past[bucket])).astype(np.float32)[:, None] * back
    return Model((vectors @ (layer[1] - layer[0])).astype(np.float64), float(bias[1] - bias[0]))


def learn(docs: DataFrame, labels: DataFrame, label: str = "quality", limit: int = TRAIN_ROWS) -> Model:
    """The model of at most limit labelled rows of docs whose crc32(doc_id) mod 5 isn't 0."""
    known = labels.where(f"doc_id is not null and {label} in (0, 1)").where(crc_of_id() % 5 != 0).select("doc_id", F.col(label).cast("int").alias("label"))
    known = known.join(docs.select("doc_id"), "doc_id", "left_semi")  # those of other documents would use up the limit
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(2 * limit)
    found = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").withColumn("order", F.xxhash64("doc_id", "label", "text"))
    rows = sample(found, ["order"], "text", limit, TRAIN_BYTES).select("text", "label")

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = pa.Table.from_batches(batches, pa.schema([("text", pa.string()), ("label", pa.int32())])).to_pydict()
        if seen["label"]:
            model = fit([t or "" for t in seen["text"]], seen["label"])
            yield pa.RecordBatch.from_arrays([pa.array([model.weight.tobytes()], pa.binary()), pa.array([model.bias])], names=["weights", "bias"])

    # the bounded sample is learned from in one task, so the driver holds but the model
    found = rows.coalesce(1).mapInArrow(train, "weights binary, bias double").first()
    return Model(np.frombuffer(found.weights, np.float64), found.bias) if found else Model(np.zeros(BUCKETS), 0.0)


def score(df: DataFrame, model: Model, text: str = "text", name: str = "score") -> DataFrame:
    """df with each text's probability of label 1."""
    shared = df.sparkSession.sparkContext.broadcast(model)
    keep = [c for c in df.columns if c != name]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, text, 1 << 20):
            got = shared.value.score(part.column(part.schema.get_field_index(text)))
            yield pa.RecordBatch.from_arrays([*(part.column(part.schema.get_field_index(c)) for c in keep), pa.array(got)], names=[*keep, name])

    return df.mapInArrow(run, T.StructType([*(df.schema[c] for c in keep), T.StructField(name, T.DoubleType())]))


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """docs that the classifier doesn't reject."""
    return score(docs, learn(docs, labels), name="__score").where(F.col("__score") >= REJECT_BELOW).select(docs.columns)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = learn(docs, table(spark, sf_dir, "labels"))
    return score(docs, model).select("doc_id", (crc_of_id() % 5 == 0).alias("held_out"), "score", (F.col("score") >= REJECT_BELOW).cast("int").alias("predicted"))
