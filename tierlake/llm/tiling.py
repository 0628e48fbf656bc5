"""Benchmark decontamination by greedy string tiling.

Every window of ``min_match`` tokens gets a Karp-Rabin hash. Windows of the
documents are joined to windows of the benchmark items; along one diagonal
(document position minus item position) consecutive windows make a longer match.
Per document and item the longest match whose tokens are all unmarked is marked,
again and again, what overlaps is cut to its unmarked part, until no match of
``min_match`` tokens is left. The share of an item's tokens under tiles is its
coverage, so passages in another order still count.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierlake.llm.common import KeyFilter, free_names, materialise, signed, small_side
from tierlake.llm.text import rolling, slices, words_of

MIN_MATCH, COVERAGE = 5, 0.6


#: Window matches of one document and item that are looked at together.
MATCHES = 1_000_000


def runs(i: np.ndarray, j: np.ndarray, n: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Window matches ``(item position, document position)``, or runs of ``n`` of them, put together
    to the longest runs along their diagonals. Repeated matches count once."""
    n = np.ones(len(i), np.int64) if n is None else n
    order = np.lexsort((i, j - i))
    i, j, n = i[order], j[order], n[order]
    # A run goes on where the next one begins at or before its end.
    joined = (j[1:] - i[1:] == j[:-1] - i[:-1]) & (i[1:] <= i[:-1] + n[:-1])
    first = np.flatnonzero(np.concatenate([[True], ~joined])) if len(i) else np.zeros(0, np.int64)
    last = np.append(first[1:], len(i)) - 1 if len(i) else first
    return i[first], j[first], i[last] + n[last] - i[first]


def tiles(seeds: list[tuple[int, int]], width: int) -> list[tuple[int, int, int]]:
    """:func:`greedy` from window matches ``(item position, document position)``."""
    pairs = np.array(seeds, np.int64).reshape(-1, 2)
    return greedy(*runs(pairs[:, 0], pairs[:, 1]), width)


def greedy(i: np.ndarray, j: np.ndarray, n: np.ndarray, width: int) -> list[tuple[int, int, int]]:
    """Greedy tiling from runs of ``n`` window matches.

    Returns ``(item start, document start, length)``, no token in two tiles.
    Longest first; ties by item position, then document position.
    """
    heap = list(zip((-(n + width - 1)).tolist(), i.tolist(), j.tolist(), strict=True))
    heapq.heapify(heap)
    item_marks, doc_marks, out = set(), set(), []
    while heap:
        length, i, j = heapq.heappop(heap)
        free = [i + k not in item_marks and j + k not in doc_marks for k in range(-length)]
        if all(free):
            out.append((i, j, -length))
            item_marks.update(range(i, i - length))
            doc_marks.update(range(j, j - length))
            continue
        k = 0
        while k < len(free):
            end = k
            while end < len(free) and free[end]:
                end += 1
            if end - k >= width:
                heapq.heappush(heap, (-(end - k), i + k, j + k))
            k = end + 1
    return out


def _item_seeds(min_match: int):
    schema = pa.schema([("item_id", pa.int64()), ("n_tokens", pa.int32()), ("width", pa.int32()),
                        ("seed", pa.int64()), ("places", pa.list_(pa.int32())), ("digest", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, _, _, hashes, first = words_of(batch.column("text"), plain=True)
            for item, a, b in zip(batch.column("item_id").to_pylist(), first[:-1], first[1:], strict=True):
                if a == b:
                    continue
                width = min(min_match, int(b - a))
                windows = rolling(hashes[a:b], width)
                seeds, where = np.unique(windows, return_inverse=True)
                places = [np.flatnonzero(where == k).astype(np.int32) for k in range(len(seeds))]
                whole = signed(rolling(hashes[a:b], int(b - a)))
                yield pa.record_batch([pa.array([item] * len(seeds), pa.int64()), pa.array([b - a] * len(seeds), pa.int32()),
                                       pa.array([width] * len(seeds), pa.int32()), pa.array(signed(seeds)),
                                       pa.array(places, pa.list_(pa.int32())), pa.array(np.repeat(whole, len(seeds)))], schema=schema)

    return run


def _doc_seeds(keys: KeyFilter, widths: list[int], min_match: int):
    schema = pa.schema([("key", pa.int64()), ("doc_id", pa.int64()), ("place", pa.int32()), ("seed", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                raw, starts, _, hashes, first = words_of(part.column("text"), plain=True)
                line = np.searchsorted(np.flatnonzero(raw == ord("\n")), starts)
                key = part.column("key").to_numpy()
                for width in widths:
                    windows = rolling(hashes, width)
                    at = np.flatnonzero(keys.may_hold(windows))
                    doc = np.searchsorted(first, at, side="right") - 1
                    inside = at + width <= first[doc + 1]
                    at, doc = at[inside], doc[inside]
                    if width < min_match:
                        # Short items: the whole document or whole lines only.
                        begins, ends = at == first[doc], at + width == first[doc + 1]
                        one_line = line[at] == line[at + width - 1]
                        begins_line = begins | (line[at] != line[np.maximum(at - 1, 0)])
                        ends_line = ends | (line[at + width - 1] != line[np.minimum(at + width, len(line) - 1)])
                        alone = (begins & ends) | (one_line & begins_line & ends_line)
                        at, doc = at[alone], doc[alone]
                    yield pa.record_batch([pa.array(key[doc]), part.column("doc_id").take(pa.array(doc)),
                                           pa.array((at - first[doc]).astype(np.int32)), pa.array(signed(windows[at]))], schema=schema)

    return run


def _runs_of(places: np.ndarray, seeds: np.ndarray, item_seeds: np.ndarray, item_places: pa.ListArray):
    """Runs of window matches from the document's (place, seed) and the item's places of each seed.

    Matches are made ``MATCHES`` at a time, so a document and an item that both repeat
    one word need memory for their runs, not for all pairs of places."""
    order = np.argsort(places, kind="stable")
    places, at = places[order], np.searchsorted(item_seeds, seeds[order])
    ends = np.asarray(item_places.offsets, np.int64)
    flat = item_places.values.to_numpy(zero_copy_only=False).astype(np.int64)
    many = ends[at + 1] - ends[at]
    out = tuple(np.zeros(0, np.int64) for _ in range(3))
    cut = np.searchsorted(np.cumsum(many), np.arange(MATCHES, max(1, int(many.sum())), MATCHES))
    for part in np.split(np.arange(len(places)), np.unique(cut)):
        k = many[part]
        j = np.repeat(places[part], k)
        within = np.arange(len(j)) - np.repeat(np.cumsum(k) - k, k)
        i = flat[np.repeat(ends[at[part]], k) + within]
        new = runs(i, j)
        out = runs(*(np.concatenate(x) for x in zip(out, new, strict=True)))
    return out


def _tile_rows(coverage: float):
    tile = pa.struct([("item_start", pa.int32()), ("doc_start", pa.int32()), ("length", pa.int32())])
    schema = pa.schema([("key", pa.int64()), ("doc_id", pa.int64()), ("item_id", pa.int64()),
                        ("coverage", pa.float64()), ("tiles", pa.list_(tile))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for k in range(batch.num_rows):
                r = {c: batch.column(c)[k].as_py() for c in ("key", "doc_id", "item_id", "n_tokens", "width")}
                matches, places = batch.column("matches")[k].values, batch.column("places")[k].values
                item_seeds = places.field("seed").to_numpy(zero_copy_only=False)
                order = np.argsort(item_seeds)
                i, j, n = _runs_of(matches.field("place").to_numpy(zero_copy_only=False).astype(np.int64),
                                   matches.field("seed").to_numpy(zero_copy_only=False), item_seeds[order],
                                   places.field("places").take(pa.array(order)))
                under = np.zeros(r["n_tokens"] + 1, np.int64)
                np.add.at(under, i, 1)
                np.add.at(under, i + n + r["width"] - 1, -1)
                if (np.cumsum(under)[:-1] > 0).sum() < coverage * r["n_tokens"]:
                    continue
                found = greedy(i, j, n, r["width"])
                share = sum(t[2] for t in found) / r["n_tokens"]
                if share >= coverage:
                    rows.append({"key": r["key"], "doc_id": r["doc_id"], "item_id": r["item_id"], "coverage": share,
                                 "tiles": [{"item_start": i, "doc_start": j, "length": n} for i, j, n in sorted(found)]})
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return run


def _key(docs: DataFrame):
    """A row is known by its id and text, so rows that share an id are judged apart."""
    return F.xxhash64(docs["doc_id"].cast("long"), docs["text"].cast("string"))


def contaminated(docs: DataFrame, benchmark: DataFrame, min_match: int = MIN_MATCH, coverage: float = COVERAGE) -> DataFrame:
    """Pairs of a document and a benchmark item that it holds.

    ``docs`` has ``doc_id, text``; ``benchmark`` has ``item_id, text``. Tokens are
    runs of letters, digits and non-ASCII characters with A-Z folded. Returns
    ``key, doc_id, item_id, coverage, tiles`` for coverage >= ``coverage``.

    - Items of fewer tokens than ``min_match`` must be the whole document or a whole
      line of it, as such words stand in clean texts too; items without
      tokens (NULL, empty, symbols) match nothing.
    - Items with equal tokens are one item, the one with the least id
      (:func:`for_all_items` adds the others).
    - NULL or empty documents match nothing; a NULL doc_id is judged and stays NULL.
    - Rows equal in id and text give one result; empty tables give none.
    - Of equally long matches the first in the item, then in the document, is marked first.
    - Very long texts are read whole; a task holds a document's places of benchmark windows, and
      runs of matches in place of all pairs of places.
    - Extra columns are ignored.

    A document's windows pass a fixed-size Bloom filter of the benchmark's windows
    first, so only likely matches are shuffled; the join on the window is exact.
    """
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).where("item_id IS NOT NULL")
    items = materialise(items.mapInArrow(_item_seeds(min_match), "item_id long, n_tokens int, width int, seed long, places array<int>, digest long"), "items")
    least = items.groupBy("digest", "n_tokens").agg(F.min("item_id").alias("item_id"))
    items = items.join(least, ["digest", "n_tokens", "item_id"], "left_semi") \
        .dropDuplicates(["item_id", "seed"]).select("item_id", "n_tokens", "width", "seed", "places")
    widths = sorted(r[0] for r in items.select("width").distinct().collect())  # at most min_match values
    seeds = KeyFilter.build(items.select("seed"))
    rows = docs.select(_key(docs).alias("key"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    hits = rows.mapInArrow(_doc_seeds(seeds, widths, min_match), "key long, doc_id long, place int, seed long")
    matches = hits.join(small_side(items.drop("places"), 200_000), "seed") \
        .groupBy("key", "item_id").agg(F.first("doc_id").alias("doc_id"), F.first("n_tokens").alias("n_tokens"), F.first("width").alias("width"),
                                       F.collect_set(F.struct("place", "seed")).alias("matches"))
    # A tiling of the needed coverage has at least one window for every ``width`` tokens that it covers.
    matches = matches.where(F.col("width") * F.size("matches") >= F.lit(coverage) * F.col("n_tokens") - F.col("width"))
    places = items.groupBy("item_id").agg(F.collect_list(F.struct("seed", "places")).alias("places"))
    return matches.join(small_side(places, 20_000), "item_id").mapInArrow(_tile_rows(coverage), "key long, doc_id long, item_id long, coverage double, "
                              "tiles array<struct<item_start:int,doc_start:int,length:int>>")


def for_all_items(pairs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The pairs of :func:`contaminated`, also for the items with the same tokens as the one of least id."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).where("item_id IS NOT NULL")
    items = materialise(items.mapInArrow(_item_seeds(MIN_MATCH), "item_id long, n_tokens int, width int, seed long, places array<int>, digest long")
                        .select("item_id", "n_tokens", "digest").distinct(), "equal_items")
    least = items.groupBy("digest", "n_tokens").agg(F.min("item_id").alias("least"))
    equal = materialise(items.join(least, ["digest", "n_tokens"]).select(F.col("least").alias("item_id"), F.col("item_id").alias("equal")).distinct(), "equal_items")
    return pairs.join(small_side(equal, 200_000), "item_id").withColumn("item_id", F.col("equal")).select(*pairs.columns)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, **how) -> DataFrame:
    """``docs`` without the documents that hold a benchmark item; all columns stay."""
    found = materialise(contaminated(docs, benchmark, **how).select("key").distinct(), "contaminated")
    name, gone = free_names(docs, "key_of_row", "key_gone")
    return docs.withColumn(name, _key(docs)).join(small_side(found.withColumnRenamed("key", gone), 1_000_000), F.col(name) == F.col(gone), "left_anti").drop(name)
