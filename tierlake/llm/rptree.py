"""Near-duplicate vectors by a forest of random-projection trees.

Each tree splits the vectors again and again by a random direction near the
median; vectors close to a split go to both sides (spill). Vectors are compared
within leaves of the same label. The forest's splits come from a bounded sample;
every vector of the table runs through all trees.

Leaves are worked on in blocks of bounded size: a leaf that outgrows a block
compares its blocks pair by pair, so no leaf is cut short. A pair that shares
several leaves counts in the first of them only, so links are counted without
emitting pairs; for the components a block emits one edge per vector.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierlake.llm.common import materialise, uniform
from tierlake.llm.graph import components

#: Bound of the sample that the splits are fitted on.
SAMPLE = 10_000
TREES, SPILL, LEAF, BLOCK, SEED = 6, 0.08, 800, 1_500, 42


@dataclass
class Tree:
    """A complete binary tree; node ``k`` has the children ``2k+1`` and ``2k+2``."""

    directions: np.ndarray  # nodes x dimensions
    low: np.ndarray  # vectors below this go left only
    high: np.ndarray  # vectors above this go right only

    @classmethod
    def grow(cls, sample: np.ndarray, depth: int, spill: float, draw: np.random.Generator) -> Tree:
        nodes = 2**depth - 1
        tree = cls(draw.normal(size=(nodes, sample.shape[1])), np.zeros(nodes), np.zeros(nodes))
        held = {0: np.arange(len(sample))}
        for k in range(nodes):
            rows = held.pop(k)
            if len(rows):
                at = sample[rows] @ tree.directions[k]
                middle = draw.uniform(0.45, 0.55)
                tree.low[k], split, tree.high[k] = np.quantile(at, [max(middle - spill, 0), middle, min(middle + spill, 1)])
                held[2 * k + 1], held[2 * k + 2] = rows[at <= split], rows[at > split]
            else:
                held[2 * k + 1], held[2 * k + 2] = rows, rows
        return tree

    def leaves(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, leaf) pairs; a row in the overlap of a split has several."""
        rows, at = np.arange(len(x)), np.zeros(len(x), np.int64)
        depth = int(np.log2(len(self.low) + 1))
        for _ in range(depth):
            by = np.einsum("ij,ij->i", x[rows], self.directions[at])
            left, right = by <= self.high[at], by >= self.low[at]
            rows, at = np.concatenate([rows[left], rows[right]]), np.concatenate([2 * at[left] + 1, 2 * at[right] + 2])
        return rows, at


def _matrix(column: pa.Array) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def _assign(forests: dict[int, list[Tree]]):
    """Adds each vector's cells: (tree, leaf) codes, ascending. Vectors of a length
    that the sample lacks share one cell."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column("dim").to_numpy()
            for dim in np.unique(sizes):
                part = batch.filter(pa.array(sizes == dim))
                x = _matrix(part.column("unit"))
                rows, codes = [], []
                for t, tree in enumerate(forests.get(int(dim), [])):
                    r, leaf = tree.leaves(x)
                    rows.append(r)
                    codes.append((t << 32) + leaf)
                if rows:
                    row, code = np.concatenate(rows), np.concatenate(codes)
                else:
                    row, code = np.arange(len(x)), np.zeros(len(x), np.int64)
                order = np.lexsort((code, row))
                ends = np.searchsorted(row[order], np.arange(len(x) + 1))
                cells = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(code[order], pa.int64()))
                yield pa.RecordBatch.from_arrays([*part.columns, cells], names=[*part.schema.names, "cells"])

    return run


def _first_shared(own: list[np.ndarray], other: list[np.ndarray], cell: int) -> np.ndarray | None:
    """Whether rows of two blocks share a cell before ``cell`` (None: none has one)."""
    before = [[c[c < cell] for c in side] for side in (own, other)]
    codes = np.unique(np.concatenate([*before[0], *before[1], np.zeros(0, np.int64)]))
    if not len(codes):
        return None
    held = []
    for side in before:
        m = np.zeros((len(side), len(codes)), np.float32)
        row = np.repeat(np.arange(len(side)), [len(c) for c in side])
        m[row, np.searchsorted(codes, np.concatenate([*side, np.zeros(0, np.int64)]))] = 1
        held.append(m)
    return held[0] @ held[1].T > 0


def _compare(threshold: float):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        cell = int(rows["cell"].iloc[0])
        left, right = rows[rows.side == 0], rows[rows.side == 1]
        own = rows["low"].iloc[0] == rows["high"].iloc[0]
        right = left if own else right
        if not len(left) or not len(right):
            return pd.DataFrame({"rep": [], "links": [], "root": []}).astype("int64")
        ids = np.concatenate([left["rep"].to_numpy(), [] if own else right["rep"].to_numpy()]).astype(np.int64)
        a, b = (np.stack(side["unit"].to_list()) for side in (left, right))
        hit = a @ b.T >= threshold
        first = _first_shared([np.asarray(c) for c in left["cells"]], [np.asarray(c) for c in right["cells"]], cell)
        links = np.zeros(len(ids), np.int64)
        count = hit if first is None else hit & ~first
        if own:
            count = count & ~np.eye(len(a), dtype=bool)
        links[:len(a)] = count @ right["copies"].to_numpy()
        if not own:
            links[len(a):] = count.T @ left["copies"].to_numpy()
        # Least id that a vector reaches inside the block.
        i, j = np.nonzero(hit)
        j = j if own else j + len(a)
        root = ids.copy()
        while True:
            before = root.copy()
            np.minimum.at(root, i, root[j])
            np.minimum.at(root, j, root[i])
            if (root == before).all():
                break
        kept = (links > 0) | (root != ids)
        return pd.DataFrame({"rep": ids[kept], "links": links[kept], "root": root[kept]})

    return run


def near_vectors(vectors: DataFrame, threshold: float = 0.93, trees: int = TREES, spill: float = SPILL, leaf: int = LEAF,
                 block: int = BLOCK, sample: int = SAMPLE, seed: int = SEED) -> DataFrame:
    """One row per vector: ``vec_id, n_links, component_id, kept``.

    ``vectors`` has ``vec_id, embedding, label``; other columns are ignored.
    Vectors of equal label and length link when their cosine, in double
    precision, is at least ``threshold``; all links returned are exact.

    - A NULL label or embedding, an empty or zero vector, or one that holds NULL,
      NaN or infinity links with nothing: n_links 0, its own component, kept.
    - Vectors of equal direction are one class, compared once; ``n_links`` counts
      the other rows.
    - A row with a NULL vec_id links with nothing (component_id and kept NULL).
    - An empty table gives an empty result.

    ``sample`` bounds the vectors that the splits are fitted on; leaves hold about
    ``leaf`` vectors of a label, larger ones are compared in blocks.
    """
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label"), F.col("embedding").cast("array<double>").alias("x"))
    good = "vec_id IS NOT NULL AND label IS NOT NULL AND size(x) > 0 AND forall(x, v -> v IS NOT NULL AND abs(v) < double('infinity') AND NOT isnan(v)) AND exists(x, v -> v <> 0)"
    rows = rows.withColumn("good", F.coalesce(F.expr(good), F.lit(False)))
    scaled = F.expr("transform(x, v -> v / array_max(transform(x, w -> abs(w))))")  # no overflow in the norm
    units = rows.where("good").withColumn("x", scaled) \
        .withColumn("norm", F.expr("sqrt(aggregate(x, 0D, (s, v) -> s + v * v))")).withColumn("unit", F.expr("transform(x, v -> v / norm)")) \
        .select("vec_id", "label", F.size("x").alias("dim"), "unit")
    units = materialise(units.withColumn("class", F.xxhash64("label", "unit")), "units")
    classes = materialise(units.groupBy("class", "label", "dim", "unit").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies")), "classes")

    n = classes.count()
    drawn = classes if n <= sample else classes.where(uniform(seed, F.col("rep")) < sample / n)
    got = drawn.orderBy(F.xxhash64("rep")).limit(2 * sample).select("dim", "unit").toArrow()  # bounded
    most = classes.groupBy("label", "dim").count().agg(F.max("count")).first()[0] or 0
    draw = np.random.default_rng(seed)
    forests = {}
    sizes = got.column("dim").to_numpy()
    for dim in np.unique(sizes):
        x = _matrix(got.column("unit").filter(pa.array(sizes == dim)))
        depth = int(np.ceil(np.log2(max(1, most / leaf))))
        depth = min(depth, int(np.log2(max(1, len(x) / 8))))
        forests[int(dim)] = [Tree.grow(x, depth, spill, draw) for _ in range(trees)] if depth else []
    placed = classes.mapInArrow(_assign(forests), "class long, label " + dict(classes.dtypes)["label"] + ", dim int, unit array<double>, rep long, copies long, cells array<long>")
    placed = materialise(placed.drop("class"), "placed")
    counts = placed.select("label", "dim", F.explode("cells").alias("cell")).groupBy("label", "dim", "cell").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    cells = placed.withColumn("cell", F.explode("cells")).join(counts, ["label", "dim", "cell"]) \
        .withColumn("own", F.pmod(F.xxhash64("rep"), "blocks").cast("int")) \
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))) \
        .select("label", "dim", "cell", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"),
                F.when(F.col("own") <= F.col("other"), 0).otherwise(1).alias("side"), "rep", "copies", "unit", "cells")
    # Dealt by pair of blocks: a large leaf's pairs must not follow its rows into one task.
    pairs = ["label", "dim", "cell", "low", "high"]
    found = materialise(cells.repartition(*pairs).groupBy(*pairs).applyInPandas(_compare(threshold), "rep long, links long, root long"), "links")
    group = components(found.where("rep <> root").select("rep", "root")).withColumnRenamed("node", "rep")
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    result = classes.select("class", "rep", "copies").join(links, "rep", "left").join(group, "rep", "left") \
        .select("class", F.coalesce("component", "rep").alias("component_id"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    linked = units.select("vec_id", "class").join(result, "class").select("vec_id", "n_links", "component_id")
    alone = rows.where("NOT good").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.union(alone).withColumn("kept", F.col("vec_id") == F.col("component_id"))
