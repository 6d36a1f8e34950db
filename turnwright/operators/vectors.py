"""Dense and sparse vectors: cosine, means, similarity joins, clustering, TF-IDF."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from turnwright.operators.graph import components, unite
from turnwright.session import Shelf, stored


def dot(a: str | Column, b: str | Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def cosine(a: str, b: str) -> Column:
    """0 for empty, unequal or zero vectors."""
    norm = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when((F.size(a) == F.size(b)) & (norm > 0), dot(a, b) / norm).otherwise(0.0)


def mean_vector(df: DataFrame, keys: list[str], vector: str) -> DataFrame:
    """Element-wise mean of each group's vectors; places are averaged apart, so sums are combined before the shuffle."""
    each = df.select(*keys, F.posexplode(vector).alias("__i", "__x")).groupBy(*keys, "__i").agg(F.avg(F.col("__x").cast("double")).alias("__m"))
    return each.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct("__i", "__m"))), lambda s: s["__m"]).alias(vector))


#: Vectors of a block.
BLOCK = 2048


def unit_rows(vectors: pd.Series) -> np.ndarray:
    """Vectors as a matrix of rows of length one; zero vectors stay."""
    x = np.stack(vectors.to_numpy()).astype(float)
    norm = np.linalg.norm(x, axis=1, keepdims=True)
    return np.divide(x, norm, out=np.zeros_like(x), where=norm > 0)


def blocks_of(df: DataFrame, size: int) -> int:
    return max(1, -(-df.count() // size))


def _rows_of(df: DataFrame, key: str, vector: str, group: str) -> DataFrame:
    return df.select(key, group, F.transform(vector, lambda x: x.cast("double")).alias("v")).where("v IS NOT NULL")


def _multiplied(dealt: DataFrame, tile: list[str], key: str, group: str, least: float, same: bool) -> DataFrame:
    """Pairs of each tile's two chunks. dealt: a row for each tile that a vector is in, with key, group, v, its chunk, and the tile's chunks left and right."""
    kind = dealt.schema[key].dataType.simpleString()

    def work(part: pd.DataFrame) -> pd.DataFrame:
        i, j = part["left"].iloc[0], part["right"].iloc[0]
        one, two = part[part["chunk"] == i], part[part["chunk"] == j]
        if not len(one) or not len(two):
            return pd.DataFrame({"a": [], "b": [], "sim": []})
        sim = unit_rows(one["v"]) @ unit_rows(two["v"]).T
        a, b = np.nonzero(sim >= least)
        out = pd.DataFrame({"a": one[key].to_numpy()[a], "b": two[key].to_numpy()[b], "sim": sim[a, b], "ga": one[group].to_numpy()[a], "gb": two[group].to_numpy()[b]})
        if i == j:
            out = out[out["a"] < out["b"]]
        out = out[(out["ga"] == out["gb"]) == same]
        swap = out["a"] > out["b"]
        out.loc[swap, ["a", "b"]] = out.loc[swap, ["b", "a"]].to_numpy()
        return out[["a", "b", "sim"]]

    return dealt.groupBy(*tile, "left", "right").applyInPandas(work, f"a {kind}, b {kind}, sim double")


#: Vectors of a tile's side, in blocks; rows and columns of it multiplied at once; share of pairs up to which cells are dealt instead of tiles.
TILE, STEP, PRUNED = 8, (1024, 4096), 0.02


def _tiled(df: DataFrame, key: str, vector: str, group: str, size: int) -> DataFrame:
    """(block, ids, groups, width, v): vectors in blocks of about `size`, as bytes of floats or doubles as given; written once."""
    kinds = [df.schema[c].dataType.simpleString() for c in (key, group)]
    real = df.schema[vector].dataType.elementType.simpleString()
    real = real if real in ("float", "double") else "double"
    rows = df.select(F.col(key).alias("id"), F.col(group).alias("g"), F.col(vector).cast(f"array<{real}>").alias("v")).where("v IS NOT NULL")
    dealt = rows.repartition(blocks_of(rows, size), "id")

    def block(held: list[pa.RecordBatch], number: int) -> pa.RecordBatch:
        whole = pa.Table.from_batches(held).combine_chunks()
        x = np.concatenate([c.flatten().to_numpy(zero_copy_only=False) for c in whole["v"].chunks])
        one = [pa.ListArray.from_arrays(pa.array([0, whole.num_rows], pa.int32()), pa.concat_arrays(whole[c].chunks)) for c in ("id", "g")]
        return pa.RecordBatch.from_arrays([pa.array([number]), *one, pa.array([len(x) // whole.num_rows]), pa.array([x.tobytes()], pa.binary())], names=["block", "ids", "groups", "width", "v"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, many, number = [], 0, TaskContext.get().partitionId() << 32
        for batch in batches:
            while batch.num_rows:
                part = batch.slice(0, 2 * size - many)
                held.append(part)
                many, batch = many + part.num_rows, batch.slice(part.num_rows)
                if many == 2 * size:
                    yield block(held, number)
                    held, many, number = [], 0, number + 1
        if many:
            yield block(held, number)

    return stored(dealt.mapInArrow(run, f"block long, ids array<{kinds[0]}>, groups array<{kinds[1]}>, width long, v binary"))


def tile_pairs(df: DataFrame, key: str, vector: str, group: str, least: float, size: int = TILE * BLOCK, same: bool = False, forest: bool = False) -> DataFrame:
    """similar_pairs, by every block with every block, of each of which tasks read the file: vectors are shuffled once, whatever the number of blocks. forest: of each
    tile only so many pairs (sim null) as connect the same whole numbers."""
    kind, real = df.schema[key].dataType.simpleString(), np.float32 if df.schema[vector].dataType.elementType.simpleString() == "float" else np.float64
    blocks = _tiled(df, key, vector, group, size)
    side = lambda n: blocks.select(*(F.col(c).alias(f"{c}{n}") for c in blocks.columns))
    met = side(1).join(side(2).hint("shuffle_replicate_nl"), F.col("block1") <= F.col("block2"))

    def units(row: dict, n: int) -> np.ndarray:
        x = np.frombuffer(row[f"v{n}"].as_buffer(), real).reshape(-1, row[f"width{n}"].as_py()).astype(float)
        norm = np.linalg.norm(x, axis=1, keepdims=True)
        return np.divide(x, norm, out=np.zeros_like(x), where=norm > 0)

    def found(row: dict) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        x, y = units(row, 1), units(row, 2)
        i, j = (row[f"ids{n}"].values.to_numpy(zero_copy_only=False) for n in (1, 2))
        code = pa.concat_arrays([row["groups1"].values, row["groups2"].values]).dictionary_encode().indices.fill_null(-1).to_numpy()
        g, h = code[: len(i)], code[len(i) :]
        once = row["block1"].as_py() == row["block2"].as_py()
        for p in range(0, len(x), STEP[0]):
            for q in range(0, len(y), STEP[1]):
                sim = x[p : p + STEP[0]] @ y[q : q + STEP[1]].T
                a, b = np.divmod(np.flatnonzero(sim >= least), sim.shape[1])
                value, a, b = sim[a, b], a + p, b + q
                # rows without a group are of one group, but not of another than others
                fits = g[a] == h[b] if same else (g[a] != h[b]) & (g[a] >= 0) & (h[b] >= 0)
                fits &= (i[a] < j[b]) if once else (i[a] != j[b])
                a, b, value = i[a[fits]], j[b[fits]], value[fits]
                swap = a > b
                yield np.where(swap, b, a), np.where(swap, a, b), value

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row, nodes = {c: batch.column(c)[k] for c in batch.schema.names}, None
                for a, b, value in found(row):
                    if not forest:
                        yield pa.RecordBatch.from_arrays([pa.array(a, kinds), pa.array(b, kinds), pa.array(value, pa.float64())], names=["a", "b", "sim"])
                    elif len(a):
                        nodes, roots = unite(*((a, b) if nodes is None else (np.append(a, nodes), np.append(b, roots))))
                if nodes is not None:
                    some = nodes != roots
                    yield pa.RecordBatch.from_arrays([pa.array(roots[some], kinds), pa.array(nodes[some], kinds), pa.nulls(int(some.sum()), pa.float64())], names=["a", "b", "sim"])

    kinds = to_arrow_type(df.schema[key].dataType)
    return met.mapInArrow(run, f"a {kind}, b {kind}, sim double")


#: Cells at most, numbers in their pivots at most, and rows at most, for each cell, among which pivots are sought.
CELLS, PIVOT_NUMBERS, SOUGHT = 4096, 1 << 20, 8


def farthest(x: np.ndarray, count: int) -> np.ndarray:
    """Rows that stand far from each other: each is the farthest from those before it; fewer if there are no more distinct ones."""
    chosen, gap = [0], np.linalg.norm(x - x[0], axis=1)
    while len(chosen) < count and gap.max() > 0:
        chosen.append(int(gap.argmax()))
        gap = np.minimum(gap, np.linalg.norm(x - x[chosen[-1]], axis=1))
    return x[chosen]


class Cells:
    """Unit vectors dealt to the nearest of some pivots, and the cells that may hold a neighbour of a vector within reach."""

    def __init__(self, pivots: np.ndarray, least: float):
        self.pivots, self.reach = pivots, np.sqrt(max(0.0, 2 - 2 * least)) + 1e-7
        self.between = np.linalg.norm(pivots[:, None] - pivots[None], axis=2) if len(pivots) <= 256 else np.sqrt(np.maximum(0, 2 - 2 * pivots @ pivots.T))
        self.members = self.visitors = self.nearest = self.farthest = np.zeros(0)

    def distances(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of each vector, the distances to all pivots, and its cell."""
        far = np.sqrt(np.maximum(0, 2 - 2 * x @ self.pivots.T))
        return far, far.argmin(axis=1)

    def visits(self, far: np.ndarray, home: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(vector, cell) where a vector must be held against a later cell than its own.

        A vector nearer to pivot j than to i is beyond the plane between them, so what is in cell i is no nearer to it than to that plane; and no
        nearer than its distance to j is outside the least and greatest distances of j's members.
        """
        own = np.take_along_axis(far, home[:, None], axis=1)
        gap = np.maximum(self.between[home], 1e-12)
        near = (far * far - own * own) / (2 * gap) <= self.reach
        near &= (far - self.farthest <= self.reach) & (self.nearest - far <= self.reach)
        near &= (np.arange(len(self.pivots)) > home[:, None]) & (self.members > 0)
        return np.nonzero(near)

    def share(self) -> float:
        """Of all pairs of vectors, the share that meets."""
        n = self.members.sum()
        return float((self.members * (self.members - 1) / 2 + self.members * self.visitors).sum() / max(n * (n - 1) / 2, 1))


def _units(batch: pa.RecordBatch) -> np.ndarray:
    flat = batch.column("v").flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(batch.num_rows, -1)


def _unit_vectors(df: DataFrame, key: str, vector: str, group: str) -> DataFrame:
    """key, group and v of length one; vectors of zeros, or without a finite length, which are like no other, are left out."""
    norm = F.sqrt(dot("v", "v"))
    unit = F.transform(F.array("norm"), lambda n: F.transform("v", lambda x: x / n))[0]  # else the length is found again for each place
    return _rows_of(df, key, vector, group).withColumn("norm", norm).where("norm > 0 AND norm < double('Infinity')").select(key, group, unit.alias("v"))


def cells(units: DataFrame, key: str, least: float, count: int) -> Cells:
    """Cells for so many pivots or fewer, with their members, their radii, and how many vectors visit each."""
    width = units.select(F.size("v").alias("n")).first()
    count = max(1, min(count, CELLS, PIVOT_NUMBERS // max(1, width.n)))
    sought = units.orderBy(F.xxhash64(key), key).limit(count * SOUGHT).select("v").collect()
    out = Cells(farthest(np.array([r.v for r in sought]), count), least)
    n = len(out.pivots)

    def homes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        members, low, high = np.zeros(n, np.int64), np.full(n, np.inf), np.zeros(n)
        for batch in batches:
            far, home = out.distances(_units(batch))
            own = far[np.arange(len(home)), home]
            members += np.bincount(home, minlength=n)
            np.minimum.at(low, home, own)
            np.maximum.at(high, home, own)
        some = np.flatnonzero(members)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(members[some]), pa.array(low[some]), pa.array(high[some])], names=["cell", "n", "low", "high"])

    found = units.select("v").mapInArrow(homes, "cell int, n long, low double, high double").groupBy("cell").agg(F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high")).collect()
    out.members, out.nearest, out.farthest = np.zeros(n, np.int64), np.full(n, np.inf), np.zeros(n)
    for r in found:  # a row for each pivot
        out.members[r.cell], out.nearest[r.cell], out.farthest[r.cell] = r.n, r.low, r.high

    def visits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        visitors = np.zeros(n, np.int64)
        for batch in batches:
            visitors += np.bincount(out.visits(*out.distances(_units(batch)))[1], minlength=n)
        some = np.flatnonzero(visitors)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(visitors[some])], names=["cell", "n"])

    out.visitors = np.zeros(n, np.int64)
    for r in units.select("v").mapInArrow(visits, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect():
        out.visitors[r.cell] = r.n
    return out


def cell_pairs(units: DataFrame, key: str, group: str, least: float, where: Cells, size: int, same: bool = False) -> DataFrame:
    """similar_pairs of unit vectors, by cells: members of a cell meet each other and the cell's visitors, in chunks of about `size`."""
    own_chunks, visiting_chunks = np.maximum(1, -(-where.members // size)), -(-where.visitors // size)
    schema = f"{key} {units.schema[key].dataType.simpleString()}, {group} {units.schema[group].dataType.simpleString()}, v array<double>, tiles array<struct<cell: int, chunk: int, left: int, right: int>>"

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            far, home = where.distances(_units(batch))
            row, cell = where.visits(far, home)
            hashed = batch.column("hash").to_numpy().view(np.uint64)
            lo, hi = (hashed & np.uint64(0xFFFFFFFF)).astype(np.int64), (hashed >> np.uint64(32)).astype(np.int64)
            # each vector as a member of its cell, then as a visitor of others
            row, cell, visitor = np.append(np.arange(len(home)), row), np.append(home, cell), np.append(np.zeros(len(home), bool), np.ones(len(row), bool))
            chunk = np.where(visitor, own_chunks[cell] + hi[row] % np.maximum(1, visiting_chunks[cell]), lo[row] % own_chunks[cell])
            copies = np.where(visitor, own_chunks[cell], own_chunks[cell] + visiting_chunks[cell])
            order = np.argsort(row, kind="stable")
            row, cell, chunk, copies = row[order], cell[order], chunk[order], copies[order]
            other = np.arange(copies.sum()) - np.repeat(np.cumsum(copies) - copies, copies)
            cell, chunk = np.repeat(cell, copies), np.repeat(chunk, copies)
            tiles = pa.StructArray.from_arrays([pa.array(x.astype(np.int32)) for x in (cell, chunk, np.minimum(chunk, other), np.maximum(chunk, other))], names=["cell", "chunk", "left", "right"])
            ends = np.append(0, np.cumsum(np.bincount(row, weights=copies, minlength=len(home)))).astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column(key), batch.column(group), batch.column("v"), pa.ListArray.from_arrays(pa.array(ends), tiles)], names=[key, group, "v", "tiles"])

    dealt = units.select(key, group, "v", F.xxhash64(key).alias("hash")).mapInArrow(deal, schema).select(key, group, "v", F.inline("tiles"))
    return _multiplied(dealt, ["cell"], key, group, least, same)


def similar_pairs(df: DataFrame, key: str, vector: str, group: str, least: float, size: int = BLOCK, same: bool = False, forest: bool = False) -> DataFrame:
    """Pairs (a, b) of different groups (same: of one group) with cosine of at least `least`, exact. Null vectors are in no pair.

    On unit vectors a cosine is a distance. Each is dealt to the nearest of some pivots, about one for `size` rows, and is held only against the cells
    that may reach it by the triangle inequality. Cells are cut into chunks of about `size`, two of which are one task that multiplies two matrices, so a
    task's memory is the same at any number of rows, whatever one cell holds, and no pair below the threshold leaves it. Where little can be pruned (few rows, a
    threshold of 0 or less, or vectors without clusters) every block meets every block, read from one table of blocks. forest: pairs that connect the same (whole) keys are enough.
    """
    blocks = blocks_of(df, size)
    if blocks >= 4 and least > 0:
        units = _unit_vectors(df, key, vector, group)
        if not units.isEmpty():
            where = cells(units, key, least, blocks)
            if where.share() <= PRUNED:
                return cell_pairs(units, key, group, least, where, size, same)
    return tile_pairs(df, key, vector, group, least, min(TILE * size, max(size, -(-blocks * size // 12))), same, forest)


def top_matches(queries: DataFrame, rows: DataFrame, key: str, vector: str, k: int, row_key: str | None = None, size: int = BLOCK) -> DataFrame:
    """(query, key, score, place): of each query the k rows of greatest cosine, ties by key; row_key: the rows' key, if they are of another kind than queries, else a query isn't its own match.

    Blocks of queries meet blocks of rows, and of each pair of blocks only k rows a query go on, so nothing is held but two blocks.
    """
    m, n = blocks_of(queries, size), blocks_of(rows, size)
    kinds = queries.schema[key].dataType.simpleString(), rows.schema[row_key or key].dataType.simpleString()
    deal = lambda df, name, side, own, other, count: df.select(F.col(name).alias("id"), F.transform(vector, lambda x: x.cast("double")).alias("v"), F.lit(side).alias("side"), F.pmod(F.xxhash64(name), F.lit(m if side else n)).cast("int").alias(own), F.explode(F.sequence(F.lit(0), F.lit(count - 1))).alias(other))
    dealt = deal(queries, key, 1, "i", "j", n).unionByName(deal(rows, row_key or key, 0, "j", "i", m))

    def work(part: pd.DataFrame) -> pd.DataFrame:
        left, right = part[part["side"] == 1], part[part["side"] == 0].sort_values("id")
        if not len(left) or not len(right):
            return pd.DataFrame({"query": [], "id": [], "score": []})
        ids = right["id"].to_numpy()
        sim = unit_rows(left["v"]) @ unit_rows(right["v"]).T
        if row_key is None:
            sim[left["id"].to_numpy()[:, None] == ids[None]] = -np.inf
        best = np.argsort(-sim, axis=1, kind="stable")[:, :k]
        out = pd.DataFrame({"query": np.repeat(left["id"].to_numpy(), best.shape[1]), "id": ids[best].ravel(), "score": np.take_along_axis(sim, best, axis=1).ravel()})
        return out[out["score"] > -np.inf]

    found = dealt.groupBy("i", "j").applyInPandas(work, f"query {kinds[0]}, id {kinds[1]}, score double")
    place = F.row_number().over(W.partitionBy("query").orderBy(F.col("score").desc(), "id"))
    return found.withColumn("place", place).where(F.col("place") <= k).select("query", F.col("id").alias(row_key or key), "score", "place")


def average_linkage(sim: np.ndarray, least: float, size: np.ndarray | None = None) -> np.ndarray:
    """Labels after merging the two clusters of greatest mean similarity until it is under `least`. size: how many rows each already is."""
    label = np.arange(len(sim))
    s, size, alive = sim.astype(float).copy(), np.ones(len(sim)) if size is None else size.astype(float), np.ones(len(sim), bool)
    np.fill_diagonal(s, -np.inf)
    while alive.sum() > 1:
        a, b = np.unravel_index(np.argmax(s), s.shape)
        if s[a, b] < least:
            break
        a, b = min(a, b), max(a, b)
        s[a] = s[:, a] = (size[a] * s[a] + size[b] * s[b]) / (size[a] + size[b])
        s[a, a] = -np.inf
        s[b] = s[:, b] = -np.inf
        size[a] += size[b]
        alive[b] = False
        label[label == b] = a
    return label


#: Rows of a group whose similarities one task holds; clusters of a group that one task merges by their means alone, and how many of them it holds against the others at once.
DENSE, ALONE, STRIP = 2048, 16384, 256


def linked_means(mean: np.ndarray, least: float, size: np.ndarray) -> np.ndarray:
    """average_linkage without the table of similarities: labels of clusters given by their mean vectors and sizes.

    Each cluster keeps its nearest one. Mean similarities never grow by merging, so what was nearest bounds what is, and is sought anew only when it would be merged next.
    """
    n, into, at = len(mean), np.arange(len(mean)), np.arange(len(mean))
    mean, size, old, best, near = mean.copy(), size.astype(float), np.zeros(n, bool), np.empty(n), np.empty(n, int)
    for p in range(0, n, STRIP):
        sim = mean[p : p + STRIP] @ mean.T
        own = np.arange(len(sim))
        sim[own, p + own] = -np.inf
        near[p : p + STRIP] = sim.argmax(axis=1)
        best[p : p + STRIP] = sim[own, near[p : p + STRIP]]
    live, merges = best >= least, 0
    while len(best) and best[i := int(best.argmax())] >= least:
        if old[i]:
            sim = np.where(live, mean @ mean[i], -np.inf)
            sim[i] = -np.inf
            near[i], old[i] = sim.argmax(), False
            best[i] = sim[near[i]]
            continue
        a, b = sorted((i, int(near[i])))
        mean[a] = (size[a] * mean[a] + size[b] * mean[b]) / (size[a] + size[b])
        size[a] += size[b]
        into[at[b]], best[b], live[b] = at[a], -np.inf, False
        old |= (near == a) | (near == b)
        old[a], merges = True, merges + 1
        if merges % STRIP == 0 and 2 * (some := live & (best >= least)).sum() < len(some):  # the others never merge again
            place = np.cumsum(some) - 1
            old |= ~some[near]
            mean, size, old, best, near, at, live = mean[some], size[some], old[some], best[some], place[near[some]], at[some], live[some]
    for k in range(n):  # what a cluster goes into is before it
        into[k] = into[into[k]]
    return into


def _clusters_of(batch: pa.RecordBatch, k: int, side: str = "") -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A block's clusters by their names: (c, n, mean)."""
    c, n, mean = (batch.column(f"{x}{side}")[k].values for x in ("c", "n", "mean"))
    c = c.to_numpy(zero_copy_only=False)
    order = np.argsort(c)
    return c[order], n.to_numpy()[order], mean.flatten().to_numpy().reshape(len(c), -1)[order]


def _dealt_clusters(nodes: DataFrame, sizes: DataFrame, alone: int) -> DataFrame:
    """(g, size, block, c, n, mean): clusters of a group in one block, if they are `alone` or fewer, else in blocks of about half as many. sizes: (h, size), a row for a group."""
    many = F.when(F.col("size") <= alone, 1).otherwise(F.ceil(F.col("size") / max(1, alone // 2)))
    sized = nodes.join(F.broadcast(sizes), F.col("g").eqNullSafe(F.col("h"))).withColumn("block", F.pmod(F.xxhash64("c"), many))
    return sized.groupBy("g", "size", "block").agg(F.collect_list(F.struct("c", "n", "mean")).alias("x")).select("g", "size", "block", "x.c", "x.n", "x.mean")


def _nearest_clusters(blocks: DataFrame, least: float) -> DataFrame:
    """(c, g, near): of each cluster the one of its group that is most alike, the least of several, if it is `least` alike. A pair is multiplied once, so both see the same number; of each two blocks a row for each cluster goes on at most."""
    kind, name = blocks.schema["g"].dataType, blocks.schema["c"].dataType.elementType
    side = lambda k: blocks.select(*(F.col(x).alias(f"{x}{k}") for x in ("g", "block", "c", "n", "mean")))
    met = side(1).join(side(2).hint("shuffle_replicate_nl"), F.col("g1").eqNullSafe(F.col("g2")) & (F.col("block1") <= F.col("block2")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                (c, _, x), (d, _, y) = _clusters_of(batch, k, "1"), _clusters_of(batch, k, "2")
                once = batch.column("block1")[k] == batch.column("block2")[k]
                sides = [(ids, np.full(len(ids), -np.inf), np.zeros(len(ids), np.int64)) for ids in (c, d)]
                for p in range(0, len(x), STEP[0]):
                    for q in range(0, len(y), STEP[1]):
                        if once and q + STEP[1] <= p:
                            continue
                        sim = x[p : p + STEP[0]] @ y[q : q + STEP[1]].T
                        if once:
                            sim[np.arange(q, q + sim.shape[1])[None] <= np.arange(p, p + sim.shape[0])[:, None]] = -np.inf
                        for axis, (_, best, near), here, there in ((1, sides[0], p, q), (0, sides[1], q, p)):
                            first = sim.argmax(axis=axis)
                            value = np.take_along_axis(sim, np.expand_dims(first, axis), axis).ravel()
                            part = slice(here, here + len(first))
                            better = value > best[part]
                            best[part][better], near[part][better] = value[better], first[better] + there
                for (ids, best, near), others in zip(sides, (d, c), strict=True):
                    some = best >= least
                    columns = [pa.array(ids[some], to_arrow_type(name)), pa.repeat(batch.column("g1")[k], int(some.sum())), pa.array(best[some]), pa.array(others[near[some]], to_arrow_type(name))]
                    yield pa.RecordBatch.from_arrays(columns, names=["c", "g", "sim", "near"])

    found = met.mapInArrow(run, f"c {name.simpleString()}, g {kind.simpleString()}, sim double, near {name.simpleString()}")
    return found.groupBy("c").agg(F.first("g").alias("g"), F.max_by("near", F.struct("sim", -F.col("near"))).alias("near"))


def linked_clusters(units: DataFrame, key: str, group: str, least: float, alone: int = ALONE) -> DataFrame:
    """G3 of unit vectors v: (node, root) of those that are with others, by average linkage within each group; a cluster's name is its least key.

    The mean similarity of two clusters is the dot product of their mean vectors, so a cluster is kept as one vector, and copies are one from the start. Groups of up to `alone` clusters are one task each. In
    larger ones all pairs that are each other's nearest merge in a round, which is exact as a mean similarity is never over both of those that it was made of; for the same
    reason clusters to which none is `least` alike are done. Nearest ones are found by every block with every block of the group, so no pair that is merely similar is written.
    """
    spark, links, old = units.sparkSession, Shelf(units.sparkSession), Shelf(units.sparkSession)
    kind = units.schema[key].dataType.simpleString()
    each = units.select(F.col(key).alias("gone"), F.col(group).alias("h"), "v")
    nodes = old.put(each.groupBy(F.col("h").alias("g"), F.col("v").alias("mean")).agg(F.min("gone").alias("c"), F.count(F.lit(1)).cast("double").alias("n")))
    copies = nodes.where("n > 1").select("g", "mean", F.col("c").alias("into"))
    if not copies.isEmpty():
        links.put(each.join(copies, F.col("h").eqNullSafe(F.col("g")) & (F.col("v") == F.col("mean"))).where("gone <> into").select("gone", "into"))
    sizes = nodes.groupBy(F.col("g").alias("h")).agg(F.count(F.lit(1)).alias("size"))

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                c, n, mean = _clusters_of(batch, k)
                into = linked_means(mean, least, n)
                some = into != np.arange(len(c))
                yield pa.RecordBatch.from_arrays([pa.array(c[some]), pa.array(c[into[some]])], names=["gone", "into"])

    while True:
        new = Shelf(spark)
        blocks = new.put(_dealt_clusters(nodes, sizes, alone))
        old.clear()
        links.put(blocks.where(F.col("size") <= alone).select("c", "n", "mean").mapInArrow(finish, f"gone {kind}, into {kind}"))
        blocks = blocks.where(F.col("size") > alone)
        if blocks.isEmpty():
            new.clear()
            found = components(spark.read.schema(f"gone {kind}, into {kind}").parquet(*links.paths), "gone", "into")
            links.clear()
            return found
        nearest = new.put(_nearest_clusters(blocks, least))
        pairs = nearest.groupBy(F.least("c", "near").alias("into"), F.greatest("c", "near").alias("gone")).agg(F.count(F.lit(1)).alias("of")).where("of = 2")
        pairs = links.put(pairs.select("gone", "into"))
        named = nearest.join(pairs, F.col("c") == F.col("gone"), "left").select("c", "g", F.coalesce("into", "c").alias("d"))
        sizes = named.groupBy(F.col("g").alias("h")).agg(F.count_if(F.col("c") == F.col("d")).alias("size"))
        each = blocks.select("g", F.inline(F.arrays_zip("c", "n", "mean"))).join(named.select("c", "d"), "c")
        both = each.groupBy("g", "d").agg(F.sum("n").alias("n"), F.collect_list(F.struct("n", "mean")).alias("parts"))  # two at most
        one, two = F.col("parts")[0], F.try_element_at("parts", F.lit(2))
        mean = F.zip_with(one["mean"], two["mean"], lambda x, y: (x * one["n"] + y * two["n"]) / F.col("n"))
        nodes = both.select("g", F.col("d").alias("c"), "n", F.coalesce(mean, one["mean"]).alias("mean"))
        old = new


def linkage(df: DataFrame, key: str, vector: str, group: str, least: float, dense: int = DENSE, alone: int = ALONE) -> DataFrame:
    """(key, group, cluster) by average linkage of cosines within each group, as long as it is `least` (over 0) or more; a cluster's name is its least key.

    Groups of up to `dense` rows are merged in one task each by their similarities, larger ones by clusters' means. Vectors of zeros, and null ones, stay alone.
    """
    kind = f"{key} {df.schema[key].dataType.simpleString()}, {group} {df.schema[group].dataType.simpleString()}, cluster {df.schema[key].dataType.simpleString()}"
    rows = df.select(key, group, F.col(vector).alias("v"))
    sizes = rows.groupBy(group).agg(F.count(F.lit(1)).alias("size")).withColumnRenamed(group, "__group")
    sized = rows.join(sizes, F.col(group).eqNullSafe(F.col("__group"))).drop("__group")

    def work(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(key)
        ids, cluster, some = part[key].to_numpy(), part[key].to_numpy().copy(), part["v"].notna().to_numpy()
        if some.any():
            unit = unit_rows(part["v"][some])
            cluster[some] = ids[some][average_linkage(unit @ unit.T, least)]
        return pd.DataFrame({key: ids, group: part[group].to_numpy(), "cluster": cluster})

    small = sized.where(F.col("size") <= dense).drop("size").groupBy(group).applyInPandas(work, kind)
    large = sized.where(F.col("size") > dense).drop("size")
    if sizes.where(F.col("size") > dense).isEmpty():
        return small
    found = linked_clusters(_unit_vectors(large, key, "v", group), key, group, least, alone)
    return small.unionByName(large.select(key, group).join(found, F.col(key) == F.col("node"), "left").select(key, group, F.coalesce("root", key).alias("cluster")))


def cluster_count(n: Column) -> Column:
    """All up to nine, else half of them, nine at least."""
    return F.when(n <= 9, n).otherwise(F.least(n, F.greatest(F.lit(9), F.ceil(n / 2)))).cast("long")


def term_counts(docs: DataFrame, keys: list[str], terms: str) -> DataFrame:
    """(keys, m, n, place, term, c): of each row, the distinct terms of an array and how often it has them; m is how many they are, place their number from 0 on. All within the row."""
    rows = docs.select(*keys, F.sort_array(F.array_compact(terms)).alias("__s"))
    starts = F.filter(F.sequence(F.lit(0), F.size("__s") - 1), lambda i: (i == 0) | (F.get("__s", i) != F.get("__s", i - 1)))
    begun = rows.withColumn("__at", F.when(F.size("__s") > 0, starts))
    pairs = F.transform("__at", lambda at, k: F.struct(F.get("__s", at).alias("term"), (F.coalesce(F.get("__at", k + 1), F.size("__s")) - at).alias("c")))
    # the outer form, as for the inner one the optimiser would ask first whether there are any, and cut each text twice
    return begun.select(*keys, F.size("__at").alias("m"), F.posexplode_outer(pairs).alias("place", "p")).where("p IS NOT NULL").select(*keys, "m", "place", "p.term", "p.c")


def tf_idf(docs: DataFrame, keys: list[str], terms: str, least: int = 1) -> DataFrame:
    """(keys, term, weight) of documents with an array of terms: count over distinct terms, times ln((n + 1) / (df + 1)) + 1.

    Terms are counted within their document; what is shuffled are the sums of each term, which are combined first, and the counts to meet them. A document is one row; n counts those with a term.
    """
    counts = stored(term_counts(docs, keys, terms))
    df = counts.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.count_if(F.col("place") == 0).alias("__first"))
    n = df.agg(F.sum("__first").alias("n"))
    weight = F.col("c") / F.col("m") * (F.log((n.scalar() + 1.0) / (F.col("df") + 1.0)) + 1.0)
    return counts.join(df.where(F.col("df") >= least).drop("__first"), "term").select(*keys, "term", weight.alias("weight"))


def sparse_means(weights: DataFrame, group: str, doc: str) -> DataFrame:
    """(group, term, m): the mean weight of a term over the documents of a group; groups' documents are counted by their weights."""
    k = weights.groupBy(group, doc).agg(F.lit(1)).groupBy(group).agg(F.count(F.lit(1)).alias("k"))
    return weights.groupBy(group, "term").agg(F.sum("weight").alias("s")).join(k, group).select(group, "term", (F.col("s") / F.col("k")).alias("m"))


#: Groups up to which each has a column of its own.
WIDE = 64


def nearest_mean(weights: DataFrame, means: DataFrame, doc: str, group: str, grain: int) -> DataFrame:
    """(doc, group) of the group whose mean is most alike (cosine, to 1/grain; ties to the least name).

    A term's means come as one array of (group, m over the group's length), so a weight meets one row whatever the number of groups; a document's dot products are sums of these by group, made
    along with its own length.
    """
    norms = means.where(F.col(group).isNotNull()).groupBy(group).agg(F.sqrt(F.sum(F.col("m") * F.col("m"))).alias("length"))
    lengths = norms.orderBy(group).limit(WIDE + 1).collect()
    if len(lengths) <= WIDE:  # a column for each group, summed by document where it stands: no row for a weight and a group
        wide = means.groupBy("term").agg(*(F.sum(F.when(F.col(group) == r[0], F.col("m"))).alias(f"m{k}") for k, r in enumerate(lengths)))
        dots = weights.join(wide, "term", "left").groupBy(doc).agg(F.sqrt(F.sum(F.col("weight") * F.col("weight"))).alias("own"), *(F.sum(F.col("weight") * F.col(f"m{k}")).alias(f"dot{k}") for k in range(len(lengths))))
        each = [F.when(F.col(f"dot{k}").isNotNull(), F.struct((-F.floor(F.col(f"dot{k}") / F.lit(r.length) / F.col("own") * grain)).alias("s"), F.lit(r[0]).alias("g"))) for k, r in enumerate(lengths)]
        best = F.array_min(F.array(*each)) if each else F.lit(None).cast(f"struct<s: long, g: {means.schema[group].dataType.simpleString()}>")
        return dots.select(doc, best["g"].alias(group)).where(F.col(group).isNotNull())
    unit = means.join(norms, group).select("term", F.struct(F.col(group).alias("g"), "m", "length").alias("x"))
    by_term = unit.groupBy("term").agg(F.collect_list("x").alias("xs"))  # a group each
    length = weights.groupBy(doc).agg(F.sqrt(F.sum(F.col("weight") * F.col("weight"))).alias("own"))
    dots = weights.join(by_term, "term").select(doc, "weight", F.explode("xs").alias("x")).groupBy(doc, F.col("x.g").alias(group)).agg(F.sum(F.col("weight") * F.col("x.m")).alias("dot"), F.first("x.length").alias("length"))
    score = F.floor(F.col("dot") / F.col("length") / F.col("own") * grain)
    return dots.join(length, doc).groupBy(doc).agg(F.min_by(group, F.struct((-score).alias("s"), F.col(group).alias("g"))).alias(group))
