"""Token ids in wavelet-matrix shards.

Documents are ordered by doc_id with a range partitioning, tokenised, and packed
into shards of about a million ids. A shard is one self-contained binary image:
document ids and lengths, then one bit-plane per bit of a token id with a rank
directory. It answers access, counting and occurrence lookup without unpacking.

Spark's Parquet writer stores the images, one row each, so they go wherever Spark
can write; executors need no file system of their own.
"""

from __future__ import annotations

import struct
import sys
import types
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tierlake.llm.common import shared_folder, trim_memory
from tierlake.llm.text import buffer_of, slices, words_of

MAGIC = b"WVM1"
_HEAD = "<4sBxxxQQ"
#: Bits between two entries of the rank directory.
STEP = 512
SHARD_TOKENS = 1 << 20
END_ID = 2


class WaveletMatrix:
    """A sequence of non-negative integers as bit-planes, highest bit first.

    At each level the sequence is stably partitioned by that bit: zeros, then
    ones. ``directory`` holds the number of ones before every ``STEP`` bits.
    """

    def __init__(self, n: int, planes: list[np.ndarray], zeros: np.ndarray, directory: list[np.ndarray]):
        self.n, self.planes, self.zeros, self.directory = n, planes, zeros, directory

    @classmethod
    def build(cls, ids: np.ndarray) -> WaveletMatrix:
        now = ids.astype(np.uint16 if len(ids) == 0 or ids.max() < 1 << 16 else np.uint32)
        width = max(1, int(now.max()).bit_length()) if len(now) else 1
        planes, zeros, directory = [], [], []
        for level in reversed(range(width)):
            bit = (now >> now.dtype.type(level)) & now.dtype.type(1) != 0
            packed = np.packbits(bit, bitorder="little")
            packed = np.concatenate([packed, np.zeros(-len(packed) % (STEP // 8), np.uint8)])
            per_step = np.bitwise_count(packed.view(np.uint64)).reshape(-1, STEP // 64).sum(axis=1)
            planes.append(packed)
            directory.append(np.concatenate([[0], np.cumsum(per_step)]).astype("<u4"))
            zeros.append(len(bit) - int(directory[-1][-1]))
            now = np.concatenate([now.compress(~bit), now.compress(bit)])
        return cls(len(ids), planes, np.array(zeros, "<u8"), directory)

    def _ones(self, level: int, at: int) -> int:
        """Ones among the first ``at`` bits of a level."""
        block = at // STEP
        part = self.planes[level][block * STEP // 8:(at + 7) // 8]
        total = int(self.directory[level][block])
        if len(part):
            bits = np.unpackbits(part, bitorder="little")[:at - block * STEP]
            total += int(bits.sum())
        return total

    def access(self, at: int) -> int:
        """The value at a position."""
        value = 0
        for level in range(len(self.planes)):
            bit = self.planes[level][at >> 3] >> (at & 7) & 1
            ones = self._ones(level, at)
            at = int(self.zeros[level]) + ones if bit else at - ones
            value = value << 1 | int(bit)
        return value

    def rank(self, value: int, end: int) -> int:
        """How often ``value`` occurs before position ``end``."""
        if value >> len(self.planes):
            return 0
        low = 0
        for level in range(len(self.planes)):
            a, b = self._ones(level, low), self._ones(level, end)
            if value >> (len(self.planes) - 1 - level) & 1:
                low, end = int(self.zeros[level]) + a, int(self.zeros[level]) + b
            else:
                low, end = low - a, end - b
        return end - low

    def count(self, value: int) -> int:
        return self.rank(value, self.n)

    def select(self, value: int, k: int) -> int:
        """Position of the ``k``-th occurrence (from 0); IndexError if there is none."""
        if not 0 <= k < self.count(value):
            raise IndexError(k)
        low, high = 0, self.n
        while high - low > 1:
            mid = (low + high) // 2
            low, high = (mid, high) if self.rank(value, mid) <= k else (low, mid)
        return low

    def values(self) -> np.ndarray:
        """The whole sequence, from the lowest plane up."""
        now = np.zeros(self.n, np.uint16 if len(self.planes) <= 16 else np.uint32)
        for power, level in enumerate(reversed(range(len(self.planes)))):
            bit = np.unpackbits(self.planes[level], count=self.n, bitorder="little").view(bool)
            zeros = int(self.zeros[level])
            before = np.empty_like(now)
            before[np.flatnonzero(~bit)] = now[:zeros]
            before[np.flatnonzero(bit)] = now[zeros:] | now.dtype.type(1 << power)
            now = before
        return now


def pack_shard(doc_ids: list[int | None], lengths: list[int], ids: np.ndarray) -> bytes:
    """One shard's image: header, null flags, doc ids, lengths, zeros, planes, directories."""
    matrix = WaveletMatrix.build(ids)
    known = np.array([d is not None for d in doc_ids], np.uint8)
    parts = [struct.pack(_HEAD, MAGIC, len(matrix.planes), len(ids), len(doc_ids)), known.tobytes(),
             np.array([d or 0 for d in doc_ids], "<i8").tobytes(), np.array(lengths, "<u8").tobytes(),
             matrix.zeros.tobytes(), *[p.tobytes() for p in matrix.planes], *[d.tobytes() for d in matrix.directory]]
    return b"".join(parts)


def open_shard(image: bytes) -> tuple[list[int | None], np.ndarray, WaveletMatrix]:
    """(doc ids, lengths, matrix) of a shard's image."""
    magic, width, n, docs = struct.unpack_from(_HEAD, image)
    if magic != MAGIC:
        raise ValueError("not a wavelet-matrix shard")
    at = struct.calcsize(_HEAD)

    def take(kind: str, count: int) -> np.ndarray:
        nonlocal at
        got = np.frombuffer(image, kind, count, at)
        at += got.nbytes
        return got

    known, doc_ids, lengths, zeros = take("u1", docs), take("<i8", docs), take("<u8", docs), take("<u8", width)
    steps = -(-n // STEP)
    planes = [take("u1", steps * STEP // 8) for _ in range(width)]
    directory = [take("<u4", steps + 1) for _ in range(width)]
    return ([int(d) if k else None for d, k in zip(doc_ids, known, strict=True)], lengths,
            WaveletMatrix(n, planes, zeros, directory))


def worker_state() -> dict:
    """A dictionary that lives as long as the Python worker, over all its tasks."""
    return sys.modules.setdefault("_llm_worker_state", types.ModuleType("_llm_worker_state")).__dict__


class WordEncoder:
    """Token ids of whole texts from the ids of their words.

    Only for tokenizers that lower-case, give white space no ids, never join what
    ASCII white space or a border of ASCII letter and punctuation parts, and close
    each pre-token with an end-of-word token. Each distinct word is then encoded
    once per worker and kept; a text's ids are its words' ids in order. Texts
    that spell a special token are parted at white space only.
    """

    MOST_WORDS = 500_000

    def __init__(self, path: str, mark: str = "<|endoftext|>"):
        from tokenizers import Tokenizer

        self.tokenizer, self.mark = Tokenizer.from_file(path), mark
        vocabulary = self.tokenizer.get_vocab()
        self.mark_id = vocabulary[mark]
        self.closes = np.zeros(max(vocabulary.values()) + 1, bool)
        self.closes[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.special = [t.content.lower().encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self._forget()

    @classmethod
    def of_worker(cls, path: str) -> WordEncoder:
        kept = worker_state()
        if path not in kept:
            kept[path] = cls(path)
        return kept[path]

    def _forget(self) -> None:
        # Sorted hashes of the words and their numbers, as arrays: a dictionary of as many takes ten times the memory.
        self.known, self.numbers = np.zeros(0, np.uint64), np.zeros(0, np.int32)
        self.lengths, self.begins = np.zeros(1 << 18, np.int32), np.zeros(1 << 18, np.int64)
        self.pool, self.pooled = np.zeros(1 << 20, np.uint16), 0

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.int64)

    def _encode_words(self, words: list[str]) -> list[np.ndarray]:
        ids: list[np.ndarray | None] = [None] * len(words)
        # Words of letters only are one pre-token each: the end-of-word tokens part them.
        letters = [k for k, w in enumerate(words) if w.isalpha()]
        for k in range(0, len(letters), 400):
            some = letters[k:k + 400]
            got = self._ids(" ".join([words[i] for i in some]))
            ends = np.flatnonzero(self.closes[got]) + 1
            if len(ends) == len(some):
                for i, a, b in zip(some, [0, *ends[:-1].tolist()], ends.tolist(), strict=True):
                    ids[i] = got[a:b]
        # For the others a special token between the words does.
        others = [k for k, x in enumerate(ids) if x is None and self.mark not in words[k]]
        for k in range(0, len(others), 400):
            some = others[k:k + 400]
            got = self._ids(self.mark.join([words[i] for i in some]))
            for i, part in zip(some, np.split(got, np.flatnonzero(got == self.mark_id)), strict=True):
                ids[i] = part[1:] if len(part) and part[0] == self.mark_id else part
        return [self._ids(words[k]) if x is None else x for k, x in enumerate(ids)]

    def _find(self, hashes: np.ndarray) -> np.ndarray:
        """Numbers of the words with these hashes, -1 for words not kept."""
        if not len(self.known):
            return np.full(len(hashes), -1, np.int64)
        at = np.minimum(np.searchsorted(self.known, hashes), len(self.known) - 1)
        return np.where(self.known[at] == hashes, self.numbers[at], -1).astype(np.int64)

    def _learn(self, hashes: np.ndarray, words: list[str]) -> None:
        ids = self._encode_words(words)
        lengths = np.array([len(x) for x in ids], np.int64)
        n, total = len(self.known), int(lengths.sum())
        while n + len(ids) > len(self.lengths):
            self.lengths, self.begins = np.concatenate([self.lengths, self.lengths * 0]), np.concatenate([self.begins, self.begins * 0])
        while self.pooled + total > len(self.pool):
            self.pool = np.concatenate([self.pool, self.pool * 0])
        if total:
            got = np.concatenate(ids)
            if got.max() >= 1 << 16 and self.pool.dtype == np.uint16:
                self.pool = self.pool.astype(np.uint32)
            self.pool[self.pooled:self.pooled + total] = got
        self.lengths[n:n + len(ids)] = lengths
        self.begins[n:n + len(ids)] = self.pooled + np.cumsum(lengths) - lengths
        order = np.argsort(hashes)
        at = np.searchsorted(self.known, hashes[order])
        self.known = np.insert(self.known, at, hashes[order])
        self.numbers = np.insert(self.numbers, at, n + order)
        self.pooled += total

    def encode(self, column: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, each closed by ``end_id``; number of ids of each text)."""
        data = buffer_of(column)[0].tobytes()
        folded = data.lower()
        plain = not any(s in folded for s in self.special)
        _, starts, ends, hashes, first = words_of(column, lower=plain, split_kinds=plain)
        codes, distinct = pd.factorize(hashes)
        if len(self.known) > self.MOST_WORDS:
            self._forget()
        at = self._find(distinct)
        new = np.flatnonzero(at < 0)
        if len(new):
            where = np.empty(len(distinct), np.int64)
            where[codes[::-1]] = np.arange(len(codes))[::-1]
            source = folded if plain else data
            n = len(self.known)
            self._learn(distinct[new], [source[a:b].decode() for a, b in zip(starts[where[new]].tolist(), ends[where[new]].tolist(), strict=True)])
            at[new] = np.arange(n, n + len(new))
        word = at[codes]
        long, begin = self.lengths[word].astype(np.int64), self.begins[word]
        before = np.concatenate([[0], np.cumsum(long)])
        per_doc = before[first[1:]] - before[first[:-1]]
        total = int(before[-1])
        out = np.full(total + len(per_doc), end_id, self.pool.dtype)
        closing = np.cumsum(per_doc + 1) - 1
        kept = np.ones(len(out), bool)
        kept[closing] = False
        out[kept] = self.pool[np.repeat(begin - before[:-1], long) + np.arange(total)]
        return out, per_doc + 1


def _shards(tokenizer_path: str, end_id: int, shard_tokens: int):
    schema = pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("before", pa.int64()), ("n_tokens", pa.int64()), ("image", pa.large_binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        trim_memory()
        part, seq, before = TaskContext.get().partitionId(), 0, 0
        encoder = WordEncoder.of_worker(tokenizer_path)
        doc_ids: list[int | None] = []
        lengths: list[int] = []
        held: list[np.ndarray] = []

        def close() -> pa.RecordBatch:
            nonlocal seq, before, doc_ids, lengths, held
            ids = np.concatenate(held)
            row = pa.record_batch([pa.array([part], pa.int32()), pa.array([seq], pa.int32()), pa.array([before], pa.int64()),
                                   pa.array([len(ids)], pa.int64()), pa.array([pack_shard(doc_ids, lengths, ids)], pa.large_binary())], schema=schema)
            seq, before, doc_ids, lengths, held = seq + 1, before + len(ids), [], [], []
            return row

        for batch in batches:
            for piece in slices(batch):
                ids, sizes = encoder.encode(piece.column("text"), end_id)
                held.append(ids)
                lengths += sizes.tolist()
                doc_ids += piece.column("doc_id").to_pylist()
                if sum(map(len, held)) >= shard_tokens:
                    yield close()
        if doc_ids:
            yield close()

    return run


def write_token_shards(docs: DataFrame, tokenizer_path: str, path: str,
                       end_id: int = END_ID, shard_tokens: int = SHARD_TOKENS) -> None:
    """Tokenise ``docs`` in ascending doc_id order and write the shards under ``path``.

    ``docs`` needs ``doc_id`` and ``text``; other columns are ignored. A NULL or
    empty text is the end id alone. A NULL doc_id comes first and stays NULL.
    Rows that share a doc_id follow each other, ordered by a hash of their text.
    An empty table writes no shard. Shards close once they reach ``shard_tokens``;
    a longer text is never cut. Columns: ``part, seq`` (order of the shards),
    ``before`` (ids before it in its part), ``n_tokens``, ``image``.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = rows.withColumn("tie", F.xxhash64("text"))
    ordered = rows.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie").select("doc_id", "text")
    (ordered.mapInArrow(_shards(tokenizer_path, end_id, shard_tokens), "part int, seq int, before long, n_tokens long, image binary")
     .write.option("compression", "none").option("parquet.block.size", 16 << 20).parquet(path))


def read_token_shards(spark: SparkSession, path: str) -> DataFrame:
    """The shards under ``path`` with ``start``, the number of ids before each.

    The running total is over one row per part (the writer's partitions).
    """
    shards = spark.read.schema("part int, seq int, before long, n_tokens long, image binary").parquet(path)
    parts = shards.groupBy("part").agg(F.sum("n_tokens").alias("total"))
    order = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("total").over(order), F.lit(0)).alias("parts_before"))
    return shards.join(F.broadcast(parts), "part").withColumn("start", F.col("parts_before") + F.col("before"))


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    trim_memory()
    for batch in batches:
        for start, image in zip(batch.column("start").to_pylist(), batch.column("image"), strict=True):
            doc_ids, lengths, matrix = open_shard(image.as_buffer())
            ids = memoryview(matrix.values().astype("<u4")).cast("B")
            ends = np.cumsum(lengths.astype(np.int64))
            begins = ends - lengths.astype(np.int64)
            yield pa.record_batch([
                pa.array(doc_ids, pa.int64()), pa.array(start + begins, pa.int64()), pa.array(ends - begins, pa.int64()),
                pa.array([zlib.crc32(ids[4 * a:4 * b]) for a, b in zip(begins.tolist(), ends.tolist(), strict=True)], pa.int64()),
            ], names=["doc_id", "start", "n_tokens", "ids_crc32"])


def token_digests(spark: SparkSession, path: str) -> DataFrame:
    """Per document, read back from the shards: ``doc_id, start, n_tokens, ids_crc32``
    (CRC-32 of its ids as little-endian unsigned 32-bit integers)."""
    return read_token_shards(spark, path).select("start", "image").mapInArrow(
        _digests, "doc_id long, start long, n_tokens long, ids_crc32 long")


def _occurrences(token: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, image in zip(batch.column("start").to_pylist(), batch.column("image"), strict=True):
                doc_ids, lengths, matrix = open_shard(image.as_buffer())
                places = np.array([matrix.select(token, k) for k in range(matrix.count(token))], np.int64)
                owner = np.searchsorted(np.cumsum(lengths.astype(np.int64)), places, side="right")
                yield pa.record_batch([pa.array([doc_ids[d] for d in owner], pa.int64()), pa.array(start + places, pa.int64())],
                                      names=["doc_id", "position"])

    return run


def occurrences(spark: SparkSession, path: str, token: int) -> DataFrame:
    """Every place of a token id, looked up in the shards: ``doc_id, position``."""
    return read_token_shards(spark, path).select("start", "image").mapInArrow(_occurrences(token), "doc_id long, position long")


def new_shard_path(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/llm/shards-{uuid.uuid4().hex}"
