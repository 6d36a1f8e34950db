import hashlib
import math
import random

import numpy as np
import pytest

from turnwright.llm import op11_codes as op11


def brute(rows, entries=256):
    """The unpruned method, in Python's integers: code, error and label_error by row, and the codebooks' digest."""
    good = [(i, [math.floor(1024 * float(np.float32(x))) for x in v], label) for i, v, label in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    width = len(good[0][1]) // 4
    parts = [[v[k * width : (k + 1) * width] for k in range(4)] for _, v, _ in good]
    order = sorted(range(len(good)), key=lambda i: (good[i][0] is None, good[i][0] or 0, good[i][1]))[:entries]
    books = [[parts[i][k] for i in order] for k in range(4)]

    def assigned():
        out = []
        for k in range(4):
            x, c = np.array([p[k] for p in parts]), np.array(books[k])
            d = ((x[:, None] - c[None]) ** 2).sum(axis=2)
            out.append([(int(row.min()), int(row.argmin())) for row in d])
        return out

    for _ in range(4):
        for k, own in enumerate(assigned()):
            for j in range(len(books[k])):
                held = [parts[i][k] for i, (_, e) in enumerate(own) if e == j]
                if held:
                    books[k][j] = [sum(col) // len(held) for col in zip(*held, strict=True)]
    final = assigned()
    error = [sum(final[k][i][0] for k in range(4)) for i in range(len(good))]
    by = {}
    for (_, _, label), e in zip(good, error, strict=True):
        by[label] = by.get(label, 0) + e
    sha = hashlib.sha256(",".join(str(v) for b in books for entry in b for v in entry).encode()).hexdigest()
    return sorted(((i, "".join(f"{final[k][n][1]:02x}" for k in range(4)), error[n], by[label], sha) for n, (i, _, label) in enumerate(good)), key=str)


def run(spark, rows, path, kind="float"):
    spark.createDataFrame([(*r, "x", 1) for r in rows], f"vec_id long, embedding array<{kind}>, label int, vector string, own int").repartition(3).write.parquet(f"{path}/embeddings.parquet")
    return sorted(map(tuple, op11.query(spark, str(path)).collect()), key=str)


def vectors(seed, n, dim=16, spread=0.1, grid=None):
    r = np.random.default_rng(seed)
    centres = r.normal(size=(20, dim))
    v = centres[r.integers(0, 20, n)] + spread * r.normal(size=(n, dim))
    return np.round(v * grid) / grid if grid else v


def test_equals_brute_force(spark, tmp_path):
    rows = [(k * 7 % 1000, v.tolist(), [None, 1, 2][k % 3]) for k, v in enumerate(vectors(1, 1000))]
    assert run(spark, rows, tmp_path) == brute(rows)


def test_ties_and_repeats(spark, tmp_path):
    """Coarse components, so that many parts stand equally near to several entries, and many rows are equal."""
    rows = [(k, v.tolist(), 0) for k, v in enumerate(vectors(2, 700, dim=8, spread=0.6, grid=2))]
    rows += rows[:50] + [(None, rows[3][1], 5), (None, [9.0] * 8, None)]
    assert run(spark, rows, tmp_path) == brute(rows)


def test_odd_rows(spark, tmp_path):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None, 1), (2, [1.0, None, 0.0, 0.0], 1), (3, [nan, 0.0, 0.0, 0.0], 1), (4, [0.0, -inf, 0.0, 0.0], 1), (6, [0.1, 0.2, 0.3, -0.4], 2), (5, [-0.0001, 0.0, 0.5, 1.0], 2), (5, [0.0] * 4, None)]
    assert run(spark, rows, tmp_path / "a") == brute(rows)
    assert run(spark, rows[:4], tmp_path / "b") == []
    assert run(spark, [], tmp_path / "c") == []
    mixed = [*rows, (7, [1.0, 2.0], 3), (8, [], 3)]
    assert run(spark, mixed, tmp_path / "d") == brute(rows)
    assert [r[:4] for r in run(spark, [(1, [], 1), (2, [], 1)], tmp_path / "e")] == [(1, "00000000", 0, 0), (2, "00000000", 0, 0)]
    filled = run(spark, [(1, [0.5, 1.0, 2.0, 0.1, 0.2], 1)], tmp_path / "f", "double")
    assert filled == brute([(1, [0.5, 1.0, 2.0, 0.1, 0.2, 0.0, 0.0, 0.0], 1)])
    huge = run(spark, [(1, [3e38, -3e38, 0.0, 1.0], 1), (2, [1e20, 0.0, 0.0, 1.0], 1), (3, [0.0] * 4, 1)], tmp_path / "g")
    assert [r[2] for r in huge] == [0, 0, 0]


def test_whole_numbers_beyond_floating_point():
    r = random.Random(3)
    x = np.array([[r.randrange(-(1 << 27), 1 << 27) for _ in range(16)] for _ in range(50)])
    want = [[sum((int(a) - int(b)) ** 2 for a, b in zip(p, q, strict=True)) for q in x] for p in x]
    assert op11.square_distances(x, x).tolist() == want
    assert op11.pair_distances(x, x, np.repeat(np.arange(50), 50), np.tile(np.arange(50), 50)).reshape(50, 50).tolist() == want


@pytest.mark.parametrize(("seed", "grid"), [(4, None), (5, 3)])
def test_pruning_leaves_results_as_they_are(seed, grid):
    """Rounds from packed bounds give all distances' results with a fraction of them, and bounds hold."""
    x = np.floor(1024 * vectors(seed, 3000, spread=0.05, grid=grid)).astype(np.int64)
    book = op11.Book(x[:256].copy())
    own, upper, lower = op11.first(x, book)
    took = []
    for _ in range(5):
        upper, lower = op11.unpack(*op11.pack(upper, lower), 256)
        entries = np.array([x[own == j].sum(axis=0) // max((own == j).sum(), 1) if (own == j).any() else book.entries[j] for j in range(256)])
        book = op11.Book(entries, book.entries)
        own, upper, lower, n = op11.again(x, book, own, upper, lower)
        square = op11.square_distances(x, entries)
        assert (own == square.argmin(axis=1)).all()
        assert (upper >= np.sqrt(square[np.arange(len(x)), own])).all() and (lower <= np.sqrt(square)).all()
        took.append(n / square.size)
    assert max(took) < 0.2 and took[-1] < 0.12
