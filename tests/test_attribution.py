import random

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from turnwright.functions import text as t
from turnwright.operators import attribution, vectors
from turnwright.plans import registry


def documents(seed: int = 3) -> list[tuple]:
    r = random.Random(seed)
    words = [f"{a}{b}{k}" for a in "pqrs" for b in "aeiou" for k in range(10, 22)] + ["the", "of", "and", "Ähre", "x" * 90]
    rows = [(k, r.choice(["s1", "s2", "s3", "s10"]), " ".join(r.choices(words[k % 4 * 30 :], k=r.choice([0, 3, 40, 200])))) for k in range(120)]
    return [*rows, (500, "s1", None), (501, None, "pa10 Pa10, only_here"), (502, "s4", "lonely words nobody else has"), (503, "s4", "of the a b"), (504, None, "unheard")]


@pytest.mark.parametrize("table", [0, 300, None])
@pytest.mark.parametrize("wide", [2, 64])
def test_attribution_is_as_in_sql(spark, tmp_path, monkeypatch, table, wide):
    """Whether all terms stand in the table of frequent ones, some or none."""
    monkeypatch.setattr(vectors, "WIDE", wide)
    monkeypatch.setattr(attribution, "SUMS", 100)
    df = spark.createDataFrame(documents(), "doc_id long, source string, text string").repartition(3)
    df.write.parquet(str(tmp_path / "documents.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    want = {tuple(r) for r in con.execute(registry.oracle_sql()["g8_attribution"]).fetchall()}
    got = attribution.attributed(df, "doc_id", "source", "text", 1_000_000_000, table)
    assert {tuple(r) for r in got.collect()} == want and len(want) > 80


def test_no_weight_is_written_for_a_document(spark):
    """What the first pass sends grows with terms and groups."""
    df = spark.createDataFrame([(k, f"s{k % 2}", "alpha beta alpha gamma") for k in range(300)], "doc long, group string, text string")
    rows = {r.term: r for r in attribution.term_sums(df).collect()}
    assert len(rows) == 4 and all(r.df == 300 for r in rows.values()) and rows[None].by == {"s0": 150.0, "s1": 150.0}


def test_terms_are_those_of_the_scalar_function(spark):
    texts = ["The cat's claws-of_IRON 12 123", None, "", "é abc" + "z" * 200, "a1b2c3d4 " * 3 + "end", "end"]
    df = spark.createDataFrame([(k, x) for k, x in enumerate(texts)], "k int, x string")
    want = [len(r.n or []) for r in df.orderBy("k").select(t.tokens(df["x"]).alias("n")).collect()]
    row, term = attribution.term_hashes(pa.array([x and x.lower() for x in texts]))
    assert np.bincount(row, minlength=len(texts)).tolist() == want
    assert term[-1] == term[-2] and len(set(term.tolist())) == len(term) - 3
