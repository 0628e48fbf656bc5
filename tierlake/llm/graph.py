"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierlake.llm.common import materialise
from tierlake.llm.skew import join_spread

#: Edges that a task contracts at once.
CHUNK = 1_000_000


def contract(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Star edges ``(node, least node that it reaches)`` with the components of the given edges."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    i, j = ends[:len(a)], ends[len(a):]
    root = np.arange(len(nodes))
    while True:
        before = root.copy()
        least = np.minimum(root[i], root[j])
        for at in (i, j, before[i], before[j]):
            np.minimum.at(root, at, least)
        root = root[root]
        if (root == before).all():
            break
    moved = root != np.arange(len(nodes))
    return nodes[moved], nodes[root[moved]]


def _contracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each task's edges, ``CHUNK`` at a time, as stars: fewer rounds are left to shuffle."""
    held: list[pa.RecordBatch] = []

    def stars() -> pa.RecordBatch:
        a, b = (np.concatenate([x.column(k).to_numpy() for x in held]) for k in (0, 1))
        held.clear()
        return pa.RecordBatch.from_arrays([pa.array(x) for x in contract(a, b)], names=["a", "b"])

    for batch in batches:
        held.append(batch)
        if sum(x.num_rows for x in held) >= CHUNK:
            yield stars()
    if held:
        yield stars()


def _large_star(edges: DataFrame) -> DataFrame:
    """Every neighbour larger than its node is joined to the node's smallest neighbour."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return join_spread(both.where("b > a"), least, ["a"], ["b"]).select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour and the node itself are joined to the smallest neighbour."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    hung = join_spread(down, least, ["a"], ["b"]).where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return hung.union(least.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for every node that has an edge; component = smallest reachable node.

    ``edges`` has two long columns; NULL ends and loops are ignored, order and
    repeats don't matter, an empty table gives an empty result. Each step writes
    its edges under the shared folder. Before the first, each task contracts the
    edges that it reads, which loses no connection. Minima are combined map-side, and
    the edges of a hub that a large part of the nodes hang on are dealt over many tasks
    for the join back. Rounds go on until nothing changes (their
    number grows with the logarithm of the input).
    """
    a, b = edges.columns[:2]
    now = (edges.select(F.col(a).cast("long").alias("a"), F.col(b).cast("long").alias("b"))
           .where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    now = materialise(materialise(now, "edges").mapInArrow(_contracted, "a long, b long"), "edges")
    mark = None
    while True:
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if seen == mark or seen[0] == 0:
            return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
                now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
        mark = seen
        now = materialise(_small_star(materialise(_large_star(now), "edges")), "edges")
