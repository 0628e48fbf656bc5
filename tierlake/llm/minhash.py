"""Near-duplicate documents by one-permutation MinHash.

Each document's word shingles are hashed once; the hash range is cut into bins
and the least hash of each bin is kept (one-permutation hashing). Empty bins copy
a non-empty one chosen by a 2-universal probe sequence (optimal densification).
Bins are grouped into bands; documents that agree on a band share a bucket. In a
bucket every member is paired with the smallest id only (a star), which bounds
the pairs by the members. Pairs are confirmed on the full shingle sets.

A star alone can miss a link between two members that are both unlike the centre.
So the buckets that still hold members of different components are compared in
blocks on short signatures. Pairs that may reach the threshold are not emitted:
a block gives one edge per member, and the components of these edges are
clusters. Within a cluster each document's full set is sent to the blocks once,
and the pairs are confirmed there; again a block gives one edge per member.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierlake.llm.common import KeyFilter, combine, materialise, signed, trim_memory
from tierlake.llm.graph import components
from tierlake.llm.text import mix, shingle_sets, slices, words_of

BANDS, ROWS = 30, 5
#: Rows of a bucket or cluster that are compared at once, and their shingles.
BLOCK, BLOCK_SHINGLES = 1500, 2_000_000


def signatures(sets: list[np.ndarray], bins: int) -> np.ndarray:
    """Densified one-permutation signature of each non-empty sorted hash set."""
    sizes = np.array([len(s) for s in sets])
    out = np.zeros((len(sets), bins), np.uint64)
    full = np.zeros((len(sets), bins), bool)
    if not len(sets):
        return out
    x = np.concatenate(sets)
    # The bin is monotone in the hash, so the first entry of a bin is its least one.
    cell = np.repeat(np.arange(len(sets)), sizes) * bins + ((x >> np.uint64(32)) * np.uint64(bins) >> np.uint64(32)).astype(np.int64)
    first = np.ones(len(cell), bool)
    first[1:] = cell[1:] != cell[:-1]
    out.ravel()[cell[first]] = x[first]
    full.ravel()[cell[first]] = True
    row, col = np.nonzero(~full)
    attempt = 0
    while len(row):
        attempt += 1
        probe = (mix((col.astype(np.uint64) << np.uint64(32)) + np.uint64(attempt), seed=3) % np.uint64(bins)).astype(np.int64)
        found = full[row, probe]
        out[row[found], col[found]] = out[row[found], probe[found]]
        row, col = row[~found], col[~found]
    return out


def _sketch(width: int, bands: int, rows: int):
    schema = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("digest", pa.binary()),
                        ("bands", pa.list_(pa.int64())), ("signature", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trim_memory()
        for batch in batches:
            for part in slices(batch):
                _, _, _, hashes, first = words_of(part.column("text"))
                sets = list(shingle_sets(hashes, first, width))
                filled = [k for k, s in enumerate(sets) if len(s)]
                sig = signatures([sets[k] for k in filled], bands * rows)
                keys = np.stack([combine(b + 1, sig[:, b * rows:(b + 1) * rows]) for b in range(bands)], axis=1) \
                    if filled else np.zeros((0, bands), np.uint64)
                short = (sig & np.uint64(255)).astype(np.uint8)
                at = {k: n for n, k in enumerate(filled)}
                yield pa.record_batch([
                    part.column("doc_id"),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets], pa.binary()),
                    pa.array([signed(keys[at[k]]) if k in at else None for k in range(len(sets))], pa.list_(pa.int64())),
                    pa.array([short[at[k]].tobytes() if k in at else None for k in range(len(sets))], pa.binary()),
                ], schema=schema)

    return run


def _sets(width: int):
    schema = pa.schema([("id", pa.int64()), ("shingles", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trim_memory()
        for batch in batches:
            for part in slices(batch):
                _, _, _, hashes, first = words_of(part.column("text"))
                yield pa.record_batch([part.column("id"),
                                       pa.array([s.tobytes() for s in shingle_sets(hashes, first, width)], pa.binary())],
                                      schema=schema)

    return run


def _confirm(percent: int):
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trim_memory()
        for batch in batches:
            hit = np.zeros(batch.num_rows, bool)
            for k, (x, y) in enumerate(zip(batch.column("set_a"), batch.column("set_b"), strict=True)):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = np.concatenate([x, y])
                both.sort(kind="stable")
                common = int((both[1:] == both[:-1]).sum())
                hit[k] = 100 * common >= percent * (len(both) - common)
            yield pa.record_batch([batch.column("a"), batch.column("b")], schema=schema).filter(pa.array(hit))

    return run


def _sets_of(wanted: DataFrame, docs: DataFrame, width: int) -> DataFrame:
    """``id, shingles`` of the documents whose id is in ``wanted`` (distinct)."""
    texts = docs.select(F.col("doc_id").alias("id"), "text", F.xxhash64("doc_id").alias("hash"))
    texts = KeyFilter.build(wanted.select(F.xxhash64("id").alias("hash"))).keep(texts, "hash").drop("hash")
    return materialise(texts.join(wanted, "id", "left_semi").mapInArrow(_sets(width), "id long, shingles binary"), "sets")


def _confirmed(pairs: DataFrame, docs: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs whose full shingle sets reach the threshold."""
    sets = _sets_of(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct(), docs, width)
    return (pairs.join(sets.select(F.col("id").alias("a"), F.col("shingles").alias("set_a")), "a")
            .join(sets.select(F.col("id").alias("b"), F.col("shingles").alias("set_b")), "b")
            .mapInArrow(_confirm(percent), "a long, b long").distinct())


def _in_blocks(rows: DataFrame, group: str, blocks: DataFrame) -> DataFrame:
    """``rows`` once for each pair of blocks that they take part in; ``blocks`` has the
    number of blocks of each group."""
    cut = rows.join(blocks, group).withColumn("own", F.pmod(F.xxhash64("rep"), "blocks").cast("int")) \
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    keys = [F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), F.when(F.col("own") <= F.col("other"), 0).otherwise(1).alias("side")]
    return cut.select(*rows.columns, *keys)


def margin(share: float, shingles: np.ndarray, bins: int) -> np.ndarray:
    """How far the signatures of two sets may agree below their similarity ``share``.

    Six standard deviations of an agreement over the bins that the smaller set fills by
    itself (``bins * (1 - exp(-n / bins))`` of them; densified bins say nothing new). The
    chance agreement of the short hashes only raises it. A test measures the misses."""
    filled = bins * -np.expm1(-shingles / bins)
    return 6 * np.sqrt(share * (1 - share) / np.maximum(filled, 1))


def _linked(percent: int, exact: bool):
    """One edge per member of a pair of blocks: to the least member that it reaches.

    Two members link if they are of different components, their sizes allow the
    threshold and their short signatures may reach it (see :func:`margin`).
    ``exact`` also asks their full sets.
    """
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        left, right = rows[rows.side == 0], rows[rows.side == 1]
        own = rows["low"].iloc[0] == rows["high"].iloc[0]
        right = left if own else right
        if not len(left) or not len(right):
            return pd.DataFrame({"a": [], "b": []}).astype("int64")
        n = len(left)
        ids = np.concatenate([left["rep"].to_numpy(), right["rep"].to_numpy()])
        sig_a, sig_b = (np.stack([np.frombuffer(x, np.uint8) for x in side["signature"]]) for side in (left, right))
        n_a, n_b = left["n_shingles"].to_numpy(), right["n_shingles"].to_numpy()
        c_a, c_b = left["component"].to_numpy(), right["component"].to_numpy()
        if exact:
            # A block beside itself holds its sets once.
            sets = [np.frombuffer(x, np.uint64) for x in (left["shingles"] if own else [*left["shingles"], *right["shingles"]])]
            begin = np.concatenate([[0], np.cumsum([len(x) for x in sets])])
            codes, vocabulary = pd.factorize(np.concatenate(sets))
            codes, seen = codes.astype(np.int32), np.zeros(len(vocabulary), bool)
            del sets, vocabulary
            of_right = begin[:-1] if own else begin[n:-1]
        i, j = [], []
        for k in range(n):
            low, high = np.minimum(n_a[k], n_b), np.maximum(n_a[k], n_b)
            fits = (100 * low >= percent * high) & (c_a[k] != c_b)
            if own:
                fits[:k + 1] = False
            at = np.flatnonzero(fits)
            at = at[(sig_b[at] == sig_a[k]).mean(axis=1) >= percent / 100 - margin(percent / 100, low[at], sig_a.shape[1])]
            if exact and len(at):
                mine = codes[begin[k]:begin[k + 1]]
                seen[mine] = True
                sizes = n_b[at]
                ends = np.cumsum(sizes)
                flat = np.repeat(of_right[at] - (ends - sizes), sizes) + np.arange(ends[-1])
                common = np.add.reduceat(seen[codes[flat]], ends - sizes, dtype=np.int64)
                seen[mine] = False
                at = at[100 * common >= percent * (n_a[k] + sizes - common)]
            i.append(np.full(len(at), k))
            j.append(n + at)
        i, j = np.concatenate(i), np.concatenate(j)
        root = ids.copy()
        twins = np.arange(n)
        while True:
            before = root.copy()
            np.minimum.at(root, i, root[j])
            np.minimum.at(root, j, root[i])
            if own:  # each member stands on both sides
                root[:n] = root[n:] = np.minimum(root[twins], root[n + twins])
            if (root == before).all():
                break
        moved = root != ids
        return pd.DataFrame({"a": ids[moved], "b": root[moved]}).drop_duplicates()

    return run


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80,
                    bands: int = BANDS, rows: int = ROWS, block: int = BLOCK) -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id, kept``.

    ``docs`` needs ``doc_id`` and ``text``; other columns are ignored. Words are
    runs of bytes other than ASCII white space, with A-Z folded. A document's set
    is its distinct ``width``-word shingles; fewer words make one shingle of the
    whole sequence. Documents link when 100 * |A ∩ B| >= percent * |A ∪ B|.

    - NULL or empty text, or no words: n_shingles 0, linked with nothing.
    - NULL doc_id: the row is returned with its n_shingles, but is linked with nothing
      (component_id and kept NULL). Repeated doc_id: each row is returned with the least
      component of the id's rows.
    - Equal sets form one class and are never expanded into pairs.
    - Empty table: empty result.

    At similarity 0.8 the default bands miss a pair with probability 7e-6.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    every = materialise(docs.mapInArrow(_sketch(width, bands, rows),
                                           "doc_id long, n_shingles long, digest binary, bands array<long>, signature binary"), "sketches")
    docs, sketches = docs.where("doc_id IS NOT NULL"), every.where("doc_id IS NOT NULL")
    nameless = every.where("doc_id IS NULL").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    classes = materialise(sketches.where("digest IS NOT NULL").groupBy("digest")
                          .agg(F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n_shingles"),
                               F.first("bands").alias("bands"), F.first("signature").alias("signature")), "classes")
    members = classes.select("rep", "n_shingles", F.posexplode("bands").alias("band", "value")) \
        .select(F.xxhash64("band", "value").alias("bucket"), "rep", "n_shingles")
    stars = members.groupBy("bucket").agg(F.min(F.struct("rep", "n_shingles")).alias("centre"), F.count("*").alias("size")).where("size > 1")
    members = materialise(members.join(stars, "bucket").select("bucket", "size", "rep", "n_shingles", "centre"), "members")
    fits = f"100 * least(n_shingles, centre.n_shingles) >= {int(percent)} * greatest(n_shingles, centre.n_shingles)"
    pairs = members.where("rep <> centre.rep").where(fits).select(F.col("centre.rep").alias("a"), F.col("rep").alias("b")).distinct()
    pairs = materialise(pairs, "pairs")
    same_id = sketches.where("digest IS NOT NULL").join(classes.select("digest", "rep"), "digest") \
        .where("doc_id <> rep").select(F.col("rep").alias("a"), F.col("doc_id").alias("b"))
    links = materialise(_confirmed(pairs, docs, width, percent), "links")
    found = components(links)

    # What the stars leave open: buckets whose members, the centre aside, are not all in one component.
    now = members.where("rep <> centre.rep").join(found.withColumnRenamed("node", "rep"), "rep", "left") \
        .withColumn("component", F.coalesce("component", "rep"))
    now = materialise(now.select("bucket", "rep", "n_shingles", "component"), "rest")
    split = now.groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high").select("bucket")
    rest = now.join(split, "bucket", "left_semi").join(classes.select("rep", "signature"), "rep")
    blocks = rest.groupBy("bucket").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    rest = _in_blocks(rest.select("bucket", "rep", "n_shingles", "component", "signature"), "bucket", blocks)
    # Dealt by pair of blocks: a large bucket's pairs must not follow its rows into one task.
    like = rest.repartition("bucket", "low", "high").groupBy("bucket", "low", "high").applyInPandas(_linked(percent, exact=False), "a long, b long").distinct()
    cluster = materialise(components(like).select(F.col("node").alias("rep"), F.col("component").alias("cluster")), "clusters")
    whole = cluster.join(classes.select("rep", "n_shingles", "signature"), "rep").join(found.withColumnRenamed("node", "rep"), "rep", "left") \
        .join(_sets_of(cluster.select(F.col("rep").alias("id")), docs, width).withColumnRenamed("id", "rep"), "rep") \
        .select("cluster", "rep", "n_shingles", F.coalesce("component", "rep").alias("component"), "signature", "shingles")
    whole = materialise(whole, "whole")
    blocks = whole.groupBy("cluster").agg(F.ceil(F.greatest(F.count("*") / block, F.sum("n_shingles") / BLOCK_SHINGLES)).cast("int").alias("blocks"))
    more = _in_blocks(whole, "cluster", blocks).repartition("cluster", "low", "high").groupBy("cluster", "low", "high").applyInPandas(_linked(percent, exact=True), "a long, b long")
    links = links.union(materialise(more, "links"))

    found = components(links.union(same_id))
    return (sketches.select("doc_id", "n_shingles").join(found.withColumnRenamed("node", "doc_id"), "doc_id", "left")
            .select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id")).union(nameless)
            .withColumn("kept", F.col("doc_id") == F.col("component_id")))


def drop_near_duplicates(docs: DataFrame, **how) -> DataFrame:
    """``docs`` without the documents whose group has a smaller doc_id; all columns stay.

    A row with a NULL doc_id stays. Rows that repeat a kept doc_id all stay.
    """
    gone = near_duplicates(docs, **how).where("NOT kept").select(F.col("doc_id").alias("gone")).distinct()
    gone = materialise(gone, "dropped")
    return docs.join(gone, docs["doc_id"] == gone["gone"], "left_anti")
