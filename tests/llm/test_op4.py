import math
import random
import re
from collections import Counter

import pytest
import xxhash

from turnwright.llm import op4_quality as op4

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def counts(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    text = text or ""
    words, lines = WORD.findall(text), [x for x in text.split("\n") if WORD.search(x)]
    windows = [tuple(words[k : k + 8]) for k in range(len(words) - 7)]
    times, covered = Counter(windows), set()
    for k, w in enumerate(windows):
        if times[w] > 1:
            covered.update(range(k, k + 8))
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def signed(h):
    return h - (1 << 64) if h >= 1 << 63 else h


def bins(text, mask):
    one = [xxhash.xxh64(w.encode(), seed=42).intdigest() for w in WORD.findall(text or "")]
    two = [xxhash.xxh64(b.to_bytes(8, "little"), seed=xxhash.xxh64(a.to_bytes(8, "little"), seed=42).intdigest()).intdigest() for a, b in zip(one, one[1:], strict=False)]
    return [h & mask for h in one + two]


def corpus():
    r = random.Random(4)
    rows = []
    for k in range(40):
        words = [r.choice(["the", "été", "of", "a|b", "x#", "word", "中文", "THE"]) for _ in range(r.choice([3, 25, 60]))]
        text = "".join(w + r.choice([" ", "\n", " \t", "\r\n", "\x0b"]) for w in words)
        rows.append((k, text + text if r.random() < 0.3 else text))
    return rows + [(100, None), (101, ""), (102, " \n \n"), (103, "a b c\na b c\n"), (103, "a b c\na b c\n"), (None, "no id " * 10), (104, "w " * 50_000)]


def test_counts_and_ratio_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(op4, "BITS", 6)
    rows = corpus()
    docs = spark.createDataFrame([(d, t, d is not None and d % 2 == 0, "z") for d, t in rows], "doc_id long, text string, good boolean, kept string").repartition(3)
    from pyspark.sql import functions as F

    learned = op4.weights(docs, is_trusted=F.col("good"))
    raw, target = Counter(), Counter()
    for d, t in rows:
        own = bins(t, 63)
        raw.update(own)
        target.update(own if d is not None and d % 2 == 0 else [])
    weight = {b: math.log((target[b] + 1) / (target.total() + 64)) - math.log((raw[b] + 1) / (raw.total() + 64)) for b in range(64)}
    assert {r.bin: pytest.approx(r.weight) for r in learned.collect()} == weight
    expected = []
    for d, t in rows:
        own, c = bins(t, 63), counts(t)
        llr = sum(weight[b] for b in own) / len(own) if own else 0.0
        failed = c[0] < 20 or 100 * c[4] > 30 * c[0]
        expected.append((d, *c, failed, not failed and llr >= op4.THRESHOLD, round(llr, 9)))
    got = op4.judge(docs.select("doc_id", "text"), learned).collect()
    found = [(r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed, r.kept, round(r.llr, 9)) for r in got]
    assert sorted(found, key=str) == sorted(expected, key=str)


def test_query_tells_labelled_junk(spark):
    sf = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in op4.query(spark, sf).collect()}
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}
    assert set(got) == set(docs)
    for d, t in docs.items():
        r = got[d]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == counts(t)
    labels = [r for r in spark.read.parquet(f"{sf}/labels.parquet").collect() if not got[r.doc_id].base_failed]
    assert all(got[r.doc_id].kept == (r.quality == 1) for r in labels)


def test_only_built_in_functions_and_empty_tables(spark):
    plan = op4.query(spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
    none = spark.createDataFrame([], "doc_id long, text string")
    assert op4.judge(none, op4.weights(none)).count() == 0


def test_columns_of_any_name_pass_through(spark):
    names = ["bin", "row", "words", "lines", "h1", "h2", "h4", "h8", "places", "twice", "grams", "gram", "weight", "doc", "raw", "good", "a.b"]
    rows = [(k, t, *range(len(names)), "old") for k, t in ((1, "a b c " * 10), (2, None))]
    docs = spark.createDataFrame(rows, ["doc_id", "text", *names, "kept"])
    got = {r.doc_id: r for r in op4.judge(docs, op4.weights(docs)).collect()}
    assert all([r[c] for c in names] == list(range(len(names))) for r in got.values())
    assert got[1].n_words == 30 and got[1].base_failed and got[2].n_words == 0 and got[1].kept is False
