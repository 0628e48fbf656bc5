"""Ranked lexical search by dense blocked matrix products.

The terms of a bounded block of items make up a compact vocabulary. One pass over
the documents keeps, per document, its number of terms and the counts of the terms in that
vocabulary (a small Parquet table); Spark adds up the corpus statistics from it.
Each task then turns its documents, a tile at a time, into a dense float64 matrix of
term impacts and multiplies it (BLAS) with the matrix of item weights. All entries are
integers. The vocabulary is cut into tiles such that no sum of a tile reaches 2**53, so every
product is exact; tiles are added up in int64. A task keeps the best ``top`` documents
of each item in the report's full order (score, then doc_id), so ties never depend on how
the rows were dealt, and Spark merges the tasks' short lists.

Edge cases: NULL, empty and wordless texts are no documents of the corpus and are never
found; an item without terms has no rows. Repeated document rows count as often as they
stand there; repeated item rows get the same list each. Documents of equal score come
by ascending doc_id, NULL ids last. Very long texts are read in pieces
cut between terms. Empty tables give an empty report. Further columns of either
table are not read.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierlake.llm.common import materialise
from tierlake.llm.segments import segments
from tierlake.llm.skew import top_per_group
from tierlake.llm.text import _LOWER, _NOT_PLAIN, span_hashes, word_bounds

#: A block of items: about so many rows and bytes are brought to the driver at a time.
BLOCK_ITEMS, BLOCK_BYTES = 2048, 8 << 20
#: Documents and vocabulary columns of one dense tile.
TILE_DOCS, TILE_TERMS = 512, 2048
#: Every sum inside one product stays below this.
EXACT = 2**53
#: An impact, (10**9 * tf) div (1000 * tf + 12 * m) with m >= 0, is never above this.
MAX_IMPACT = 10**6
PIECE_BYTES = 1 << 20


def _lanes(raw: np.ndarray, starts: np.ndarray, lengths: np.ndarray, lane: int) -> np.ndarray:
    """Bytes 8*lane … 8*lane+7 of each span as one number, zero behind its end.
    ``raw`` is lower-cased and has 8 more bytes than the spans reach."""
    left = np.clip(lengths - 8 * lane, 0, 8)
    at = np.minimum(starts + 8 * lane, len(raw) - 8)
    words = np.lib.stride_tricks.as_strided(raw, (len(raw) - 7, 8), (1, 1))[at].copy().view("<u8")[:, 0]
    keep = np.where(left == 8, np.uint64(2**64 - 1), (np.uint64(1) << (left * 8).astype(np.uint64)) - np.uint64(1))
    return words & keep


class Vocabulary:
    """The distinct terms of a block of texts, found again in other texts by their
    hash and then compared byte for byte."""

    def __init__(self, texts: list[str]):
        raw, offsets = _joined(texts)
        starts, ends = word_bounds(raw, offsets, plain=True)
        low = np.concatenate([_LOWER[raw], np.zeros(8, np.uint8)])
        terms = [low[s:e].tobytes() for s, e in zip(starts, ends, strict=True)]
        self.terms = sorted(set(terms))
        place = {t: i for i, t in enumerate(self.terms)}
        owner = np.searchsorted(offsets, starts, side="right") - 1
        #: (text, term, occurrences) of the texts given.
        pairs = np.array([place[t] for t in terms], np.int64) + owner * max(1, len(self.terms))
        keys, self.counts = np.unique(pairs, return_counts=True)
        self.texts, self.columns = np.divmod(keys, max(1, len(self.terms)))
        flat = np.frombuffer(b"".join(self.terms) + bytes(8), np.uint8)
        self.lengths = np.array([len(t) for t in self.terms], np.int64)
        begin = np.concatenate([[0], np.cumsum(self.lengths)])[:-1].astype(np.int64)
        hashes = span_hashes(flat, begin, begin + self.lengths, lower=False) if self.terms else np.zeros(0, np.uint64)
        if len(np.unique(hashes)) != len(hashes):
            raise ValueError("two terms of one block share a 64-bit hash; use smaller blocks")
        self.order = np.argsort(hashes)
        self.hashes = hashes[self.order]
        self.lane = [_lanes(flat, begin, self.lengths, k) for k in range(-(-int(self.lengths.max(initial=0)) // 8))]

    def find(self, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Column of each span's term, -1 for terms that are not in the vocabulary."""
        out = np.full(len(starts), -1, np.int64)
        if not self.terms or not len(starts):
            return out
        low = np.concatenate([_LOWER[raw], np.zeros(8, np.uint8)])
        hashes = span_hashes(low[:-8], starts, ends, lower=False)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        hit = np.flatnonzero(self.hashes[at] == hashes)
        column, start, length = self.order[at[hit]], starts[hit], (ends - starts)[hit]
        same = self.lengths[column] == length
        for k, lane in enumerate(self.lane):
            at_k = np.flatnonzero(same & (length > 8 * k))
            if not len(at_k):
                break
            same[at_k] &= lane[column[at_k]] == _lanes(low, start[at_k], length[at_k], k)
        out[hit[same]] = column[same]
        return out


def _joined(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    data = [t.encode() for t in texts]
    return np.frombuffer(b"".join(data), np.uint8), np.concatenate([[0], np.cumsum([len(d) for d in data])]).astype(np.int64)


def _term_counts(vocabulary: Vocabulary) -> Callable:
    width = max(1, len(vocabulary.terms))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total = np.zeros(batch.num_rows, np.int64)
            keys, counts = [], []
            for raw, offsets, docs in segments(batch.column("text"), _NOT_PLAIN, PIECE_BYTES):
                starts, ends = word_bounds(raw, offsets, plain=True)
                owner = docs[np.searchsorted(offsets, starts, side="right") - 1]
                total += np.bincount(owner, minlength=batch.num_rows)
                column = vocabulary.find(raw, starts, ends)
                k, c = np.unique(owner[column >= 0] * width + column[column >= 0], return_counts=True)
                keys.append(k)
                counts.append(c)
            key, back = np.unique(np.concatenate(keys) if keys else np.zeros(0, np.int64), return_inverse=True)
            tf = np.bincount(back, np.concatenate(counts), minlength=len(key)).astype(np.int64) if len(key) else key
            docs, columns = np.divmod(key, width)
            found = np.flatnonzero(total)
            ends = np.searchsorted(docs, found, side="right")
            first = np.searchsorted(docs, found)
            offsets = np.concatenate([[0], np.cumsum(ends - first)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id").cast(pa.int64()).take(pa.array(found)), pa.array(total[found]),
                pa.ListArray.from_arrays(pa.array(offsets), pa.array(columns.astype(np.int32))),
                pa.ListArray.from_arrays(pa.array(offsets), pa.array(tf))], names=["doc_id", "n", "terms", "tf"])

    return count


def weight_tiles(vocabulary: Vocabulary, df: dict[int, int], n_docs: int, n_items: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """``(columns, weights)`` per vocabulary tile; ``weights`` is columns x items in float64.

    A tile ends before ``TILE_TERMS`` columns are over and before the sum of any item's
    weights times ``MAX_IMPACT`` could reach ``EXACT``. A weight too large for that on its own
    (a term hundreds of thousands of times in one item) is dealt over several tiles.
    """
    limit = (EXACT - 1) // MAX_IMPACT
    w = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df.get(c, 0) + 1)))
                  for c in range(len(vocabulary.terms))], np.int64)
    order = np.argsort(vocabulary.columns, kind="stable")
    column, item = vocabulary.columns[order], vocabulary.texts[order]
    weight = w[column] * vocabulary.counts[order]
    tiles: list[tuple[np.ndarray, np.ndarray]] = []
    held: list[tuple[int, np.ndarray]] = []
    load = np.zeros(n_items, np.int64)

    def close() -> None:
        if held:
            tiles.append((np.array([c for c, _ in held]), np.array([r for _, r in held], np.float64)))
            held.clear()
            load[:] = 0

    bounds = np.searchsorted(column, np.arange(len(vocabulary.terms) + 1))
    for c in range(len(vocabulary.terms)):
        row = np.zeros(n_items, np.int64)
        row[item[bounds[c]:bounds[c + 1]]] = weight[bounds[c]:bounds[c + 1]]
        while row.any():
            part = np.minimum(row, limit)
            if len(held) == TILE_TERMS or (load + part > limit).any():
                close()
            held.append((c, part))
            load += part
            row = row - part
    close()
    return tiles


def impacts(tf: np.ndarray, n: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """(10**9 * tf) div (1000 * tf + 12 * m), m = 75 + (25 * n * N) div L, in whole numbers."""
    if n.size and 25 * int(n.max()) * n_docs >= 2**63:
        m = np.array([75 + 25 * int(x) * n_docs // n_terms for x in n], np.int64)
    else:
        m = 75 + 25 * n * n_docs // n_terms
    return 10**9 * tf // (1000 * tf + 12 * m)


class _Best:
    """The first ``top`` (score descending, id ascending, no id last) of each item so far."""

    def __init__(self, n_items: int, top: int):
        self.top = top
        self.floor = np.ones(n_items, np.int64)
        self.rows = [np.zeros(0, np.int64) for _ in range(4)]  # item, score, id, 1 if there is no id

    def add(self, scores: np.ndarray, ids: np.ndarray, no_id: np.ndarray) -> None:
        doc, item = np.nonzero(scores >= self.floor)
        if not len(doc):
            return
        rows = [np.concatenate(x) for x in zip(self.rows, (item, scores[doc, item], ids[doc], no_id[doc]), strict=True)]
        order = np.lexsort((rows[2], rows[3], -rows[1], rows[0]))
        rows = [x[order] for x in rows]
        place = np.arange(len(order)) - np.searchsorted(rows[0], rows[0])
        self.rows = [x[place < self.top] for x in rows]
        last = place == self.top - 1
        self.floor[rows[0][last]] = rows[1][last]


def _best_of_task(tiles: list, n_terms: int, n_items: int, n_docs: int, corpus_terms: int, top: int) -> Callable:
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = _Best(n_items, top)
        for batch in batches:
            for at in range(0, batch.num_rows, TILE_DOCS):
                tile = batch.slice(at, TILE_DOCS)
                lists = tile.column("terms")
                lengths = np.asarray(lists.value_lengths())
                columns = lists.flatten().to_numpy(zero_copy_only=False)
                doc = np.repeat(np.arange(tile.num_rows), lengths)
                n = tile.column("n").to_numpy(zero_copy_only=False)
                impact = impacts(tile.column("tf").flatten().to_numpy(zero_copy_only=False), n[doc], n_docs, corpus_terms)
                scores = np.zeros((tile.num_rows, n_items), np.int64)
                for used, weights in tiles:
                    # Compact: only the tile's columns that some document of this tile holds.
                    local = np.full(n_terms, -1, np.int64)
                    held = np.intersect1d(columns, used)
                    local[held] = np.arange(len(held))
                    here = local[columns] >= 0
                    dense = np.zeros((tile.num_rows, len(held)))
                    dense[doc[here], local[columns[here]]] = impact[here]
                    scores += (dense @ weights[np.searchsorted(used, held)]).astype(np.int64)
                ids = tile.column("doc_id")
                best.add(scores, ids.fill_null(0).to_numpy(zero_copy_only=False),
                         ids.is_null().to_numpy(zero_copy_only=False).astype(np.int64))
        item, score, ids, no_id = best.rows
        yield pa.RecordBatch.from_arrays([pa.array(item.astype(np.int32)), pa.array(ids, mask=no_id == 1), pa.array(score)],
                                         names=["item", "doc_id", "score"])

    return search


def _rank_block(docs: DataFrame, texts: list[str], top: int) -> DataFrame:
    """(text, rank, doc_id, score) of a bounded list of distinct item texts."""
    spark = docs.sparkSession
    vocabulary = Vocabulary(texts)
    kept = materialise(docs.select("doc_id", "text").mapInArrow(
        _term_counts(vocabulary), "doc_id long, n long, terms array<int>, tf array<long>"), "term-counts")
    size = kept.agg(F.count(F.lit(1)).alias("docs"), F.coalesce(F.sum("n"), F.lit(1)).alias("terms")).first()
    # One number per term of the bounded vocabulary comes back.
    df = {r.term: r.df for r in kept.select(F.explode("terms").alias("term")).groupBy("term")
          .agg(F.count(F.lit(1)).alias("df")).collect()}
    tiles = weight_tiles(vocabulary, df, size.docs, len(texts))
    found = kept.mapInArrow(_best_of_task(tiles, len(vocabulary.terms), len(texts), size.docs, size.terms, top),
                            "item int, doc_id long, score long")
    best = top_per_group(found, ["item"], [F.desc("score"), F.asc_nulls_last("doc_id")], ["doc_id"], top)
    names = spark.createDataFrame(list(enumerate(texts)), "item int, text string")
    return best.join(F.broadcast(names), "item").select("text", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, top: int = 20) -> DataFrame:
    """``item_id, rank, doc_id, score``: for each row of ``items`` (item_id, text) the
    ``top`` documents (doc_id, text) of highest score above 0; see the module's docstring.

    Items are taken in blocks of about ``BLOCK_ITEMS`` rows or ``BLOCK_BYTES`` bytes, each
    with a pass over the documents; equal item texts are ranked once.
    """
    items = items.select("item_id", "text")
    texts = items.where("text IS NOT NULL").select("text").distinct()
    size = texts.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("bytes")).first()
    blocks = max(1, -(-size.n // BLOCK_ITEMS), -(-size.bytes // BLOCK_BYTES))
    out = None
    for b in range(blocks):
        block = sorted(r.text for r in texts.where(F.pmod(F.xxhash64("text"), F.lit(blocks)) == b).collect())
        ranked = _rank_block(docs, block, top)
        out = ranked if out is None else out.unionByName(ranked)
    return items.join(out, "text").select("item_id", "rank", "doc_id", "score")
