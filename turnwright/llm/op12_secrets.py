"""Secrets in texts: three plain rules, and strings that look drawn at random rather than written.

The rules find assignments to words like password or token, access keys, and long hexadecimal numbers. Beside them, every long run of letters, digits and
the signs of base 64 is scored by two character Markov models, one of random strings and one of ordinary identifiers; a run whose log-likelihood ratio
passes a threshold is a span of kind random, unless a span of the rules holds it. The models are learned from labelled samples: random strings are the values
that the rules find in a bounded sample of documents, and strings written from digests in the usual alphabets; ordinary ones are the sample's other runs,
alone, in capitals and joined as identifiers are, with characters repeated, digits and signs now and then, as in numbers, dates and rules across a page. A sample is the documents that come first by the crc32 of their id, SAMPLE_ROWS and SAMPLE_BYTES of them at most,
none over SAMPLE_TEXT bytes; all documents are scanned whole.

Defined results: a null or empty text has no spans; equal texts have equal spans, whatever their ids; a null doc_id stays null; other columns pass through, but for one named found,
which is replaced. Matches of a rule never overlap each other; spans of different kinds may. Without documents the models know only the written strings.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from turnwright.llm.clusterio import crc_of_id, sample, table
from turnwright.llm.words import gather, raw, slices

KINDS = ("assign", "access", "hex", "random")
ASSIGN = re.compile(rb"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([a-z0-9+/_.=-]+)""")  # of lower-cased bytes
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
VALUE_LEAST, ACCESS_LEAST, HEX_LEAST = 6, 20, 24
#: Runs of so many characters are scored, and are random if the ratio's logarithm passes THRESHOLD and PER_CHARACTER for each of them.
RUN_LEAST, THRESHOLD, PER_CHARACTER = 16, 10.0, 0.4
SAMPLE_ROWS, SAMPLE_BYTES, SAMPLE_TEXT = 500, 16 << 20, 1 << 18
#: Random strings written from digests, in each of four alphabets; what a pair of characters counts before it is seen.
WRITTEN, SMOOTHING = 500, 0.5
#: Of what follows a character in ordinary strings, the share that repeats it, beyond what the sample has; after a digit or sign, the share of each digit or sign.
REPEATED = 0.05
PIECE = 1 << 20

SIGNS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
LETTERS = 52  # what follows are digits and signs
_CODE = np.full(256, -1, np.int16)
_CODE[np.frombuffer(SIGNS, np.uint8)] = np.arange(len(SIGNS))
_HEX = np.zeros(256, bool)
_HEX[np.frombuffer(b"0123456789abcdef", np.uint8)] = True


def runs(buf: np.ndarray, offsets: np.ndarray, within: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Longest stretches of bytes of a class, in one row each, of a least length: starts and ends."""
    mark = np.zeros(len(buf) + 2, np.int8)
    mark[1:-1] = within[buf]
    edge = np.flatnonzero(np.diff(mark))
    start, end = edge[::2], edge[1::2]
    inner = np.unique(offsets[1:-1])
    inner = inner[(inner > 0) & (inner < len(buf))]
    if len(inner):
        inner = inner[within[buf[inner]] & within[buf[inner - 1]]]  # a run goes on in the next row
        start, end = np.sort(np.append(start, inner)), np.sort(np.append(end, inner))
    long = end - start >= least
    return start[long], end[long]


def rule_spans(data: bytes, buf: np.ndarray, offsets: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the three rules, in bytes, by start and kind."""
    lower, out = data.lower(), []
    some = ASSIGN.search(lower), ACCESS.search(data)
    for s, e in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        if some[0]:
            out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(lower, s, e) if m.end(1) - m.start(1) >= VALUE_LEAST]
        if some[1]:
            out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(data, s, e) if m.end() - m.start() >= ACCESS_LEAST]
    out += [(s, 2, e) for s, e in zip(*(x.tolist() for x in runs(buf, offsets, _HEX, HEX_LEAST)), strict=True)]
    return sorted(out)


def transitions(strings: list[bytes], repeated: float = 0.0) -> np.ndarray:
    """Logarithms of the chances of a character after another; the last row is a string's start. repeated: a share that is added for the same character again, and for digits and signs after each other."""
    n = len(SIGNS)
    seen = np.full((n + 1, n), SMOOTHING)
    flat = np.frombuffer(b"".join(strings), np.uint8)
    if len(flat):
        code = _CODE[flat].astype(np.int64)
        before = np.append(n, code[:-1])
        starts = np.cumsum([0, *map(len, strings[:-1])])
        before[starts] = n
        np.add.at(seen, (before, code), 1)
    alike = np.eye(n, dtype=bool)
    alike[LETTERS:, LETTERS:] = True  # numbers, dates and rules
    seen[:n] += repeated * seen[:n].sum(axis=1, keepdims=True) * alike
    return np.log(seen / seen.sum(axis=1, keepdims=True))


def ratios(model: np.ndarray, buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Of each run, the logarithm of its chance as a random string over that as an ordinary one."""
    if not len(start):
        return np.zeros(0)
    flat, edges = gather(buf, start, end)
    code = _CODE[flat].astype(np.int64)
    before = np.append(0, code[:-1])
    before[edges[:-1]] = len(SIGNS)
    return np.add.reduceat(model[before, code], edges[:-1])


def random_runs(model: np.ndarray, buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    start, end = runs(buf, offsets, _CODE >= 0, RUN_LEAST)
    found = ratios(model, buf, start, end)
    good = (found > THRESHOLD) & (found > PER_CHARACTER * (end - start))
    return start[good], end[good]


def written() -> list[bytes]:
    """Random strings in small hexadecimal digits, base 64, capital letters with digits, and its small and capital mix."""
    out = []
    for k in range(WRITTEN):
        digest = hashlib.sha256(str(k).encode()).digest()
        out += [digest.hex().encode(), base64.b64encode(digest), base64.b32encode(digest).rstrip(b"="), base64.urlsafe_b64encode(digest).rstrip(b"=")]
    return out


def labelled(texts: list[str]) -> tuple[list[bytes], list[bytes]]:
    """Random and ordinary strings of texts: values and numbers that the rules find, and all other runs, alone and joined."""
    secret, plain = [], []
    for text in texts:
        data = text.encode()
        lower = data.lower()
        buf, offsets = np.frombuffer(data, np.uint8), np.array([0, len(data)])
        spans = rule_spans(data, buf, offsets)
        for s, kind, e in spans:
            value = data[ASSIGN.match(lower, s, e).start(1) : e].replace(b".", b"") if kind == 0 else data[s:e]
            secret += [value] * bool(value)
        starts, ends = runs(buf, offsets, _CODE >= 0, 2)
        held, reach = [], 0
        for s, _, e in spans:
            if s >= reach:
                held.append([s, e])
            held[-1][1] = reach = max(e, held[-1][1])
        edges = np.array(held, np.int64).reshape(-1, 2)
        k = np.searchsorted(edges[:, 1], starts, side="right")
        free = np.append(edges[:, 0], len(buf) + 1)[k] >= ends
        words = [data[s:e] for s, e in zip(starts[free].tolist(), ends[free].tolist(), strict=True)]
        plain += words + [w.upper() for w in words[::8]]
        plain += [(b"_", b"-", b"/", b"")[i % 4].join((x, y.capitalize() if i % 4 == 3 else y)) for i, (x, y) in enumerate(zip(words[::2], words[1::2], strict=False))]
    return secret, plain


def first_texts(docs: DataFrame) -> list[str]:
    """The texts of the sample. Only documents whose crc32 is low enough for some four times as many are put in order; all are if these turn out to be too few."""
    known = docs.select("doc_id", F.col("text").cast("string").alias("text"), crc_of_id().alias("crc")).where(F.octet_length("text").between(1, SAMPLE_TEXT) & F.col("crc").isNotNull())
    share = 4 * SAMPLE_ROWS / max(docs.count(), 1)
    near = known.where(F.col("crc") < int(share * (1 << 32))) if share < 1 else known
    if share < 1 and near.limit(SAMPLE_ROWS).count() < SAMPLE_ROWS:
        near = known
    return [r.text for r in sample(near, ["crc", "doc_id", F.xxhash64("text"), "text"], "text", SAMPLE_ROWS, SAMPLE_BYTES).select("text").collect()]


def fit(docs: DataFrame) -> np.ndarray:
    """The logarithms of the two models' ratio, learned from the first documents."""
    secret, plain = labelled(first_texts(docs))
    return transitions(secret + written()) - transitions(plain, REPEATED)


def scan(docs: DataFrame, model: np.ndarray) -> DataFrame:
    """docs with found: an array of kind, start and end (code points, end exclusive), by start and then by kind."""
    keep = [c for c in docs.columns if c != "found"]
    span = T.StructType([T.StructField("kind", T.StringType(), False), T.StructField("start", T.IntegerType(), False), T.StructField("end", T.IntegerType(), False)])
    schema = T.StructType([*(f for f in docs.schema.fields if f.name in keep), T.StructField("found", T.ArrayType(span, False))])
    names = np.array(KINDS)

    def spans(column: pa.Array) -> pa.Array:
        buf, offsets = raw(column)
        data = buf.tobytes()
        found = rule_spans(data, buf, offsets)
        of_rules = np.array([(s, e) for s, _, e in found], np.int64).reshape(-1, 2)
        reach = np.append(-1, np.maximum.accumulate(of_rules[:, 1])) if len(of_rules) else np.array([-1])
        start, end = random_runs(model, buf, offsets)
        new = reach[np.searchsorted(of_rules[:, 0], start, side="right")] < end
        found = sorted([*found, *((s, 3, e) for s, e in zip(start[new].tolist(), end[new].tolist(), strict=True))])
        s, kind, e = np.array(found, np.int64).reshape(-1, 3).T
        chars = np.concatenate([[0], np.cumsum((buf & 0xC0) != 0x80)])
        own = chars[offsets[np.searchsorted(offsets, s, side="right") - 1]]
        values = pa.StructArray.from_arrays([pa.array(names[kind], pa.string()), pa.array((chars[s] - own).astype(np.int32)), pa.array((chars[e] - own).astype(np.int32))], names=["kind", "start", "end"])
        return pa.ListArray.from_arrays(pa.array(np.searchsorted(s, offsets).astype(np.int32)), values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", PIECE):
            at = {c: batch.schema.get_field_index(c) for c in keep}
            yield pa.RecordBatch.from_arrays([*(batch.column(at[c]) for c in keep), spans(batch.column(at["text"]))], names=[*keep, "found"])

    return docs.mapInArrow(run, schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The spans of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.col("text").cast("string").alias("text"))
    found = scan(docs, fit(docs)).drop("text")
    say = lambda spans: F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
    of = lambda kind: F.filter("found", lambda x: x["kind"] == kind)
    return found.select(
        "doc_id",
        *(F.size(of(k)).cast("long").alias(f"n_{k}") for k in KINDS[:3]),
        F.sha2(say(F.filter("found", lambda x: x["kind"] != KINDS[3])).cast("binary"), 256).alias("base_sha256"),
        say(F.col("found")).alias("spans"),
        F.size(of(KINDS[3])).cast("long").alias("n_random"),
    )
