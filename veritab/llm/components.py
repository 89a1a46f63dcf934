"""Connected components by alternating stars."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veritab.llm.common import releasing, stored


class Forest:
    """Union-find in which the least member leads."""

    def __init__(self):
        self.up: dict[int, int] = {}

    def find(self, x: int) -> int:
        up = self.up
        root = x
        while (p := up.get(root, root)) != root:
            root = p
        while x != root:
            up[x], x = root, up.get(x, x)
        return root

    def join(self, a: int, b: int) -> None:
        a, b = self.find(a), self.find(b)
        if a != b:
            self.up[max(a, b)] = min(a, b)


#: Edges that a task contracts at once.
EDGES = 250_000


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges of a task as stars around least members, EDGES at a time: no more edges than nodes."""

    def stars(forest):
        nodes = list(forest.up)
        return pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array([forest.find(x) for x in nodes], pa.int64())], names=["hi", "lo"])

    forest, n = Forest(), 0
    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            forest.join(a, b)
        n += batch.num_rows
        if n > EDGES:
            yield stars(forest)
            forest, n = Forest(), 0
    yield stars(forest)


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("hi", "lo")), F.sum(F.xxhash64("lo", "hi").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the least node that edges reach. Edges: two long columns; nodes without edges are not returned.

    Each round links the larger neighbours of a node to its least neighbour, then the smaller ones, until the edges
    are stars around least nodes. Least neighbours are aggregated and joined, so the centre of a very large star is
    one row of one side of a join, and its edges can be split over tasks. Rounds are stored, and their number grows
    with the logarithm of the nodes. Before the first, lots of ``EDGES`` edges are contracted; where there is one lot
    only, that is the result.
    """
    a, b = edges.columns
    pairs = stored(edges.where(F.col(a) != F.col(b)).select(F.col(a).alias("a"), F.col(b).alias("b")), "pairs")
    lots = -(-pairs.count() // EDGES) or 1
    now = stored(pairs.repartition(lots).mapInArrow(releasing(_contract), "hi long, lo long").where("hi != lo").distinct(), "edges")
    state = _state(now) if lots > 1 else (0,)
    while state[0]:
        both = now.unionByName(now.select(F.col("lo").alias("hi"), F.col("hi").alias("lo")))
        least = both.groupBy("hi").agg(F.min("lo").alias("m")).select("hi", F.least("hi", "m").alias("m"))
        large = both.where("lo > hi").join(least, "hi").select(F.col("lo").alias("hi"), F.col("m").alias("lo")).distinct()
        large = stored(large, "large-star")
        low = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(low, "hi").where("lo > m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
        now = stored(small.unionByName(low.select("hi", F.col("m").alias("lo"))).distinct(), "small-star")
        state, before = _state(now), state
        if state == before:
            break
    roots = now.select(F.col("lo").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return now.select(F.col("hi").alias("node"), F.col("lo").alias("component")).unionByName(roots)


def labels_of(mask: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least member that links reach, for members of both sides. mask: links between them; members may be on both sides."""
    label_l, label_r = left.copy(), right.copy()
    top = np.iinfo(np.int64).max
    while True:
        new_l = np.minimum(label_l, np.where(mask, label_r[None, :], top).min(axis=1, initial=top))
        new_r = np.minimum(label_r, np.where(mask, new_l[:, None], top).min(axis=0, initial=top))
        if (new_l == label_l).all() and (new_r == label_r).all():
            return new_l, new_r
        label_l, label_r = new_l, new_r
