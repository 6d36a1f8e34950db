import numpy as np

from tests.test_vectors import all_pairs, frame
from turnwright.operators import graph, vectors
from turnwright.plans import registry


def test_vectors_without_clusters_are_shuffled_once(spark):
    """Nothing is pruned, and yet no copy of a vector is dealt for each block that it meets."""
    x = np.random.default_rng(6).normal(size=(700, 16))
    pairs = vectors.similar_pairs(frame(spark, x), "id", "e", "g", 0.3, size=20)
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" in plan and "Exchange" not in plan
    got = [(r.a, r.b) for r in pairs.collect()]
    assert len(got) == len(set(got)) and set(got) == all_pairs(x, 0.3)
    forest = vectors.similar_pairs(frame(spark, x), "id", "e", "g", 0.6, size=20, forest=True)
    whole = vectors.similar_pairs(frame(spark, x), "id", "e", "g", 0.6, size=20)
    assert sorted(graph.components(forest).collect()) == sorted(graph.components(whole).collect())


def test_vectors_without_a_group(spark):
    rows = [(k, None if k < 3 else 1, [1.0, 0.1 * k]) for k in range(5)]
    df = spark.createDataFrame(rows, "id long, g int, e array<double>")
    assert vectors.similar_pairs(df, "id", "e", "g", 0.5).count() == 0
    assert {(r.a, r.b) for r in vectors.similar_pairs(df, "id", "e", "g", 0.5, same=True).collect()} == {(0, 1), (0, 2), (1, 2), (3, 4)}


def test_document_frequency_shuffles_terms_alone(spark, tmp_path):
    docs = spark.createDataFrame([(1, "a", "apple apple pear"), (2, "a", "apple plum"), (None, "b", "plum pear")], "doc_id long, source string, text string")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    df = registry.queries()["a13_document_frequency"](spark, str(tmp_path))
    assert [tuple(r) for r in df.collect()] == [("apple", 2)]
    assert "doc_id" not in "".join(x for x in df._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange" in x)
    docs.where("doc_id = 1").write.mode("append").parquet(str(tmp_path / "documents.parquet"))
    assert [tuple(r) for r in registry.queries()["a13_document_frequency"](spark, str(tmp_path)).collect()] == [("apple", 2)]


def test_nearest_mean_makes_no_row_for_each_group(spark, monkeypatch):
    weights = spark.createDataFrame([(1, "x", 1.0), (1, "y", 2.0), (2, "y", 1.0), (3, "z", 1.0)], "doc long, term string, weight double")
    means = spark.createDataFrame([("p", "x", 1.0), ("p", "y", 1.0), ("q", "y", 3.0), ("r", "y", 3.0)], "g string, term string, m double")
    wide = vectors.nearest_mean(weights, means, "doc", "g", 1000)
    assert "Generate" not in wide._jdf.queryExecution().executedPlan().toString()
    want = {(1, "p"), (2, "q")}
    assert {tuple(r) for r in wide.collect()} == want
    monkeypatch.setattr(vectors, "WIDE", 2)
    assert {tuple(r) for r in vectors.nearest_mean(weights, means, "doc", "g", 1000).collect()} == want
