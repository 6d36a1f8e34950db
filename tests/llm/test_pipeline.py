"""The pipeline against plain models of its stages, and what each stage returns."""

import re

import corpus_pipeline
from tests.llm import test_op1, test_op2, test_op6
from turnwright.llm import op9_classifier

SF = "/root/testdata/sf0.001"


def left_of(text, gone):
    return " ".join(w for k, w in enumerate(re.findall(r"[^\x20\x09-\x0D]+", text)) if k not in gone)


def removed(rows, size=20):
    """Of each document, the words that windows cover which start earlier elsewhere."""
    split = {d: re.findall(r"[^\x20\x09-\x0D]+", t) for d, t in rows}
    first, out = {}, {}
    for d, w in sorted(split.items()):
        for k in range(len(w) - size + 1):
            first.setdefault(tuple(w[k : k + size]), (d, k))
    for d, w in split.items():
        out[d] = {k + j for k in range(len(w) - size + 1) if first[tuple(w[k : k + size])] != (d, k) for j in range(size)}
    return out


def test_run_equals_plain_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = op9_classifier.learn(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    rows = [(r.doc_id, r.text) for r in op9_classifier.score(docs, model).where(f"score >= {op9_classifier.REJECT_BELOW}").collect()]
    firsts = {c for _, n, c in test_op6.brute(rows)}
    rows = [(d, t) for d, t in rows if d in firsts]
    gone = removed(rows)
    rows = [(d, left_of(t, gone[d]) if gone[d] else t) for d, t in rows]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    bad = {d for d, _, _ in test_op2.brute(rows, items)}
    expected = {d: test_op1.OWN.encode_ordinary(t) for d, t in rows if d not in bad}
    got = corpus_pipeline.run(spark, SF).collect()
    assert {r.doc_id: r.ids for r in got} == expected and len(got) == len(expected) and all(r.n_tokens == len(r.ids) for r in got)


def test_stages_keep_the_columns_of_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(20)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns and out.dtypes == docs.dtypes
        assert stage(spark, docs.limit(0), SF).count() == 0
