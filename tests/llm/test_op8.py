import hashlib
import random
import re

import pytest

from turnwright.llm import op8_substrings as op8


def brute(rows, size=20):
    split = [(d if d is not None else float("inf"), re.findall(r"[^\x20\x09-\x0D]+", t or "")) for d, t in rows]
    first = {}
    for d, w in split:
        for k in range(len(w) - size + 1):
            key = tuple(w[k : k + size])
            first[key] = min(first.get(key, (d, k)), (d, k))
    out = []
    for (doc, _), (d, w) in zip(rows, split, strict=True):
        gone = set()
        for k in range(len(w) - size + 1):
            if first[tuple(w[k : k + size])] < (d, k):
                gone.update(range(k, k + size))
        kept = [x for k, x in enumerate(w) if k not in gone]
        out.append((doc, len(w), len(gone), hashlib.sha256(" ".join(kept).encode()).hexdigest()))
    return sorted(out, key=str)


def run(spark, rows):
    df = spark.createDataFrame([(d, t, "y") for d, t in rows], "doc_id long, text string, n_words string").repartition(3)
    got = op8.remove_repeats(df).select("doc_id", "n_words", "n_removed", "kept_text").collect()
    return sorted(((r.doc_id, r.n_words, r.n_removed, hashlib.sha256(r.kept_text.encode()).hexdigest()) for r in got), key=str)


def corpus(seed, n=60):
    r = random.Random(seed)
    passages = [" ".join(r.choice(["été", "a", "b", "c", "dd"]) for _ in range(r.choice([19, 20, 21, 60]))) for _ in range(4)]
    rows = []
    for k in range(n):
        parts = [r.choice(passages) if r.random() < 0.6 else " ".join(r.choice("abcdefgh") + str(r.randrange(9)) for _ in range(r.choice([1, 5, 30]))) for _ in range(r.randrange(5))]
        rows.append((k, r.choice([" ", "\n", "\t \r\n"]).join(parts)))
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize("hot", [20_000, 1])
def test_equals_brute_force(spark, hot, monkeypatch):
    monkeypatch.setattr(op8, "HOT", hot)
    monkeypatch.setattr(op8, "REPORT", min(op8.REPORT, hot))
    monkeypatch.setattr(op8, "BUCKET", 200)
    rows = corpus(hot)
    assert run(spark, rows) == brute(rows)


def test_odd_rows(spark):
    long = " ".join(str(k % 700) for k in range(200_000))
    same = " ".join(map(str, range(25)))
    rows = [(1, None), (2, ""), (3, " \n"), (4, "one"), (5, same), (5, same), (6, same), (None, same), (None, "x " * 45), (7, "x " * 45), (8, long), (9, "y " + same)]
    assert run(spark, rows) == brute(rows)
    assert run(spark, []) == []


def test_dedup_keeps_columns(spark):
    rows = corpus(5, 30)
    df = spark.createDataFrame([(d, t, "en", "s", len(t)) for d, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = op8.dedup(df)
    assert got.columns == df.columns
    words = {d: n - gone for d, n, gone, _ in brute(rows)}
    for r in got.collect():
        assert len(r.text.split()) == words[r.doc_id] and r.n_chars == len(r.text)


def test_query_on_whole_table(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted((tuple(r) for r in op8.query(spark, sf).collect()), key=str) == brute(rows)


def test_thue_morse_words(spark):
    word = "a"
    for _ in range(11):
        word += word.translate(str.maketrans("ab", "ba"))
    other = word.translate(str.maketrans("ab", "ba"))
    rest = " ".join(map(str, range(19)))
    rows = [(1, f"{word} {rest}"), (2, f"{other} {rest}"), (3, f"{other} {rest}")]
    assert run(spark, rows) == brute(rows)


def test_clashing_columns(spark):
    same = " ".join(map(str, range(25)))
    names = ["windows", "doc", "text_hash", "mark", "own", "__text", "low", "bucket"]
    df = spark.createDataFrame([(k, same, *[f"{k}{c}" for c in names]) for k in range(3)], "doc_id long, text string, " + ", ".join(f"`{c}` string" for c in names))
    got = op8.remove_repeats(df)
    assert got.columns == [*df.columns, "n_words", "n_removed", "kept_text"]
    for r in got.collect():
        assert r.n_removed == (25 if r.doc_id else 0) and r.text == same and all(r[c] == f"{r.doc_id}{c}" for c in names)


def test_buckets_beyond_memory(spark, monkeypatch):
    monkeypatch.setattr(op8, "HELD", 300)
    monkeypatch.setattr(op8, "BUCKET", 1 << 30)
    rows = corpus(9, 200)
    assert run(spark, rows) == brute(rows)
