import numpy as np
import pytest

from turnwright.operators import vectors


def clustered(seed, n, dim=32, clusters=40, spread=0.03):
    r = np.random.default_rng(seed)
    centres = r.normal(size=(clusters, dim)) / np.sqrt(dim)
    own = np.minimum(r.integers(0, clusters * 3 // 2, n), clusters - 1)  # a third of all in one
    return centres[own] + spread * r.normal(size=(n, dim))


def frame(spark, x, groups=3):
    return spark.createDataFrame([(k, k % groups, v.tolist()) for k, v in enumerate(x)], "id long, g int, e array<float>").repartition(5)


def all_pairs(x, least, groups=3, same=False):
    x = x.astype(np.float32).astype(float)
    norm = np.linalg.norm(x, axis=1, keepdims=True)
    u = np.divide(x, norm, out=np.zeros_like(x), where=norm > 0)
    a, b = np.nonzero(u @ u.T >= least)
    return {(i, j) for i, j in zip(a.tolist(), b.tolist(), strict=True) if i < j and (i % groups == j % groups) == same}


@pytest.mark.parametrize(("least", "same"), [(0.85, False), (0.85, True), (0.38, False), (0.999, False)])
def test_cells_give_all_pairs(spark, least, same):
    x = clustered(1, 1500)
    x[7] = x[8] = 0
    x[9] = x[10] = x[11]
    got = [(r.a, r.b) for r in vectors.similar_pairs(frame(spark, x), "id", "e", "g", least, size=60, same=same).collect()]
    assert len(got) == len(set(got)) and set(got) == all_pairs(x, least, same=same)


def test_vectors_without_clusters(spark):
    x = np.random.default_rng(2).normal(size=(500, 16))
    got = [(r.a, r.b) for r in vectors.similar_pairs(frame(spark, x), "id", "e", "g", 0.5, size=40).collect()]
    assert len(got) == len(set(got)) and set(got) == all_pairs(x, 0.5)


def test_few_pairs_of_clustered_vectors_meet(spark):
    """At the reference's threshold: without the hot cluster's own pairs, few others meet."""
    x = clustered(3, 6000)
    units = vectors._unit_vectors(frame(spark, x), "id", "e", "g").cache()
    where = vectors.cells(units, "id", 0.85, 100)
    assert where.members.sum() == len(x)
    assert where.share() < 0.3
    even = clustered(3, 6000, clusters=60)[:]
    even = vectors.cells(vectors._unit_vectors(frame(spark, even), "id", "e", "g"), "id", 0.85, 100)
    assert even.share() < 0.3


def test_one_hot_cell_is_cut_into_chunks(spark):
    """All rows in one place: no task multiplies more than two chunks."""
    x = np.tile(np.eye(8)[:1], (600, 1)) + 1e-3 * np.random.default_rng(4).normal(size=(600, 8))
    df = frame(spark, x)
    got = vectors.similar_pairs(df, "id", "e", "g", 0.85, size=50)
    assert got.count() == len(all_pairs(x, 0.85))


def test_odd_vectors(spark):
    df = spark.createDataFrame([(k, k % 2, None if k % 5 == 0 else [0.0, 0.0] if k % 5 == 1 else [1.0, 0.0]) for k in range(40)], "id long, g int, e array<double>")
    own = {(i, j) for i in range(40) for j in range(i) if i % 5 > 1 and j % 5 > 1 and i % 2 != j % 2}
    for size in (5, 100):
        assert {(r.b, r.a) for r in vectors.similar_pairs(df, "id", "e", "g", 0.9, size=size).collect()} == own
    assert vectors.similar_pairs(df.where("e[0] = 0"), "id", "e", "g", 0.9, size=2).count() == 0
    assert vectors.similar_pairs(df.limit(0), "id", "e", "g", 0.9).count() == 0


def linked(x, least):
    """The plain method: the pair of clusters of greatest mean similarity, while it is least or more."""
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    sim, clusters = u @ u.T, [[k] for k in range(len(x))]
    while len(clusters) > 1:
        mean, i, j = max((sim[np.ix_(a, b)].mean(), -i, -j) for i, a in enumerate(clusters) for j, b in enumerate(clusters) if i < j)
        if mean < least:
            break
        clusters[-i] += clusters.pop(-j)
    return {frozenset(c) for c in clusters}


@pytest.mark.parametrize("dense", [vectors.DENSE, 12])
def test_linkage_in_one_task_and_in_rounds(spark, dense):
    x = clustered(5, 50, dim=8, clusters=6, spread=0.15)
    rows = [(k, 1, v.tolist()) for k, v in enumerate(x)] + [(100 + k, None, v.tolist()) for k, v in enumerate(x[:9])] + [(200, 1, [0.0] * 8), (201, 1, None)]
    df = spark.createDataFrame(rows, "id long, g int, e array<double>").repartition(4)
    found = {}
    for r in vectors.linkage(df, "id", "e", "g", 0.5, dense=dense).collect():
        found.setdefault((r.g, r.cluster), set()).add(r.id)
    assert all(min(c) == name for (_, name), c in found.items())
    want = linked(x, 0.5) | {frozenset(100 + k for k in c) for c in linked(x[:9], 0.5)} | {frozenset({200}), frozenset({201})}
    assert {frozenset(c) for c in found.values()} == want


@pytest.mark.parametrize("seed", range(4))
def test_linkage_by_means(seed):
    x = clustered(seed, 700, dim=12, clusters=8, spread=0.15)
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    n = np.random.default_rng(seed).integers(1, 4, len(u)).astype(float)
    for least in (0.2, 0.6, 0.9):
        assert np.array_equal(vectors.linked_means(u, least, n), vectors.average_linkage(u @ u.T, least, n))


@pytest.mark.parametrize("alone", [1000, 20])
def test_linkage_of_large_groups_writes_no_pairs(spark, monkeypatch, alone):
    """Clusters by their means, in one task and in rounds, with copies, which once merged one a round."""
    monkeypatch.setattr(vectors, "similar_pairs", lambda *a, **b: pytest.fail("a row for each similar pair"))
    x = clustered(8, 60, dim=8, clusters=6, spread=0.15)
    rows = [(k, 1, v.tolist()) for k, v in enumerate(x)] + [(100 + k, 1, x[7].tolist()) for k in range(40)] + [(200 + k, None, v.tolist()) for k, v in enumerate(x[:35])]
    rows += [(300, 1, [float("nan")] * 8), (301, 1, [0.0] * 8), (302, None, None)]
    found = {}
    for r in vectors.linkage(spark.createDataFrame(rows, "id long, g int, e array<double>").repartition(4), "id", "e", "g", 0.5, dense=12, alone=alone).collect():
        found.setdefault((r.g, r.cluster), set()).add(r.id)
    assert all(min(c) == name for (_, name), c in found.items())
    want = {frozenset(k if k < 60 else k + 40 for k in c) for c in linked(np.concatenate([x, np.tile(x[7], (40, 1))]), 0.5)} | {frozenset(200 + k for k in c) for c in linked(x[:35], 0.5)}
    assert {frozenset(c) for c in found.values()} == want | {frozenset({k}) for k in (300, 301, 302)}
