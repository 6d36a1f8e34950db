"""Connected components of an edge table."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnwright.session import Shelf

#: Edges that one task unites by itself; more take rounds of stars.
ONE_TASK = 1 << 20


def _state(e: DataFrame) -> tuple:
    return tuple(e.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(u, v))")).first())


def unite(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nodes of some edges, in order, and of each the least node that it is connected with."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    left, right, root = ends[: len(a)], ends[len(a) :], np.arange(len(nodes))
    while True:
        low = np.minimum(root[left], root[right])
        new = root.copy()
        np.minimum.at(new, root[left], low)
        np.minimum.at(new, root[right], low)
        while not np.array_equal(new, new[new]):
            new = new[new]
        if np.array_equal(new, root):
            return nodes, nodes[root]
        root = new


def components(edges: DataFrame, a: str = "a", b: str = "b", one_task: int = ONE_TASK) -> DataFrame:
    """(node, root) of every node with an edge; root is the component's smallest node. Loops, nulls and repeated edges are harmless.

    Up to one_task edges are united in one task. More are replaced in rounds by edges to the smallest neighbour (large stars, then small
    stars), summed before they are shuffled, so a node's neighbours never come together in one place; rounds are checkpointed and end when
    they change nothing.
    """
    e = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    old = Shelf(edges.sparkSession)
    e = old.put(e)
    before = _state(e)
    if before[0] <= one_task and e.schema["u"].dataType.typeName() in ("long", "integer"):

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            parts = [(x.column(0).to_numpy(), x.column(1).to_numpy()) for x in batches]
            if parts:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in unite(*(np.concatenate(side) for side in zip(*parts, strict=True)))], names=["node", "root"])

        return e.coalesce(1).mapInArrow(run, f"node {e.schema['u'].dataType.simpleString()}, root {e.schema['u'].dataType.simpleString()}")
    while before[0]:
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        near = large.join(low, "u")
        small = near.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        new = Shelf(edges.sparkSession)
        e = new.put(small)
        old.clear()
        old, now = new, _state(e)
        if now == before:
            break
        before = now
    roots = e.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.union(e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
