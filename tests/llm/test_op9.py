import zlib

import numpy as np
import pyarrow as pa

from turnwright.llm import op9_classifier as op9


def test_scoring_equals_the_two_layers():
    texts = ["a b b b", "été x y z w x y z w", "", None, "one"]
    model = op9.Model(np.random.default_rng(0).normal(size=op9.BUCKETS), 0.25)
    got = model.score(pa.array(texts, pa.string()))
    for t, s in zip(texts, got, strict=True):
        bucket, share = op9.features(t or "")
        assert not len(share) or abs(share.sum() - 1) < 1e-9
        assert abs(s - 1 / (1 + np.exp(-(share @ model.weight[bucket] + 0.25)))) < 1e-9


def test_units_of_a_text():
    w = op9.words(pa.array(["a a b c d a b c d", "a b c d"]))
    u = op9.units(w)
    marks = u.feature[np.isin(u.of, u.unit) & (u.feature < 2)]
    assert sorted(marks.tolist()) == [0, 1]
    n = len(set("abcd"))
    assert (u.unit == n).sum() == 1 and (u.unit == n + 1).sum() == 1 and set(u.row[u.unit >= n][u.unit[u.unit >= n] < n + 2]) == {0}


def test_query_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in op9.query(spark, sf).collect()}
    docs = [r.doc_id for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert sorted(docs) == sorted(got)
    right, junk, found = [], 0, 0
    for r in spark.read.parquet(f"{sf}/labels.parquet").collect():
        assert got[r.doc_id].held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        if got[r.doc_id].held_out:
            right.append(got[r.doc_id].predicted == r.quality)
            junk += r.quality == 0
            found += r.quality == 0 and got[r.doc_id].predicted == 0
    assert np.mean(right) >= 0.95 and found >= 0.7 * junk


def test_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, "q"), (2, "", "q"), (None, "a b", "q"), (3, "x " * 300_000, "q"), (3, "x " * 300_000, "q")], "doc_id long, text string, score string")
    labels = spark.createDataFrame([(1, 1), (9, 0), (3, None), (None, 1)], "doc_id long, quality int")
    got = op9.score(docs, op9.learn(docs, labels)).collect()
    assert len(got) == 5 and all(0 <= r.score <= 1 for r in got)
    empty = docs.limit(0)
    assert op9.accepted(empty, labels.limit(0)).columns == docs.columns and op9.accepted(empty, labels).count() == 0


def test_labels_without_documents_use_up_no_limit(spark):
    docs = spark.createDataFrame([(k, "good plain words here" if k % 2 else "### $$$ ###") for k in range(900_000, 900_200)], "doc_id long, text string")
    labels = spark.createDataFrame([(k, int(k % 2)) for k in [*range(5000), *range(900_000, 900_200)]], "doc_id long, quality int")
    scores = {r.doc_id: r.score for r in op9.score(docs, op9.learn(docs, labels, limit=100)).collect()}
    assert all((s > 0.5) == (d % 2 == 1) for d, s in scores.items())
