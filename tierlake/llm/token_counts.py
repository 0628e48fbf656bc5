"""Token counts per document without tokenising the documents.

A byte-pair tokenizer cuts a text into pre-tokens and merges inside each of them, so a
text's number of tokens is the sum over its pre-tokens. Executors cut the texts and count
each document's pre-tokens, a block of documents at a time (about ``BLOCK_BYTES`` of text,
or one longer document); a block keeps its distinct pre-tokens once. Spark then takes
the distinct pre-tokens of all blocks, the tokenizer's model counts the pieces of
each exactly once, and the counts come back to the blocks: those of the most frequent pre-tokens
(at most ``FREQUENT``) in a broadcast table, all others through a join. Each block adds up frequency
times pieces per document. No ids are built.

Cutting: texts of a byte-level tokenizer are cut by its pattern in Python where all of their
characters lie in ``SAME_CLASSES``; other texts, and other kinds of tokenizer, are cut by the
library itself, whose tables of letters and digits belong to another Unicode version.

Edge cases: NULL and empty texts have no bytes and no tokens; every row of the table gives a
row, rows with equal or NULL doc_id too. Added tokens (such as an end-of-text
string) inside a text count as one token each, the library's default. Very long texts are cut in parts
between two words first, where a pre-token always ends. Further columns are not read.
An empty table gives an empty result.
"""

from __future__ import annotations

import itertools
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierlake.llm.common import materialise
from tierlake.llm.skew import join_spread

BLOCK_BYTES = 4 << 20
#: Characters of one part of a long text.
PART = 1 << 20
#: Pre-tokens in the broadcast table, and their greatest length: 19 MB at most.
FREQUENT, FREQUENT_BYTES = 262_144, 64
#: A pre-token's place is one long: 20 bits of partition, 12 of block, 31 of its place in the block.
BLOCKS = 1 << 12
# Fixed value: the published pattern of byte-level tokenizers.
BYTE_LEVEL = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Latin, Greek, Cyrillic and general punctuation: letters, digits and spaces
#: there are the same in all Unicode versions in use (a test holds both cutters to that).
SAME_CLASSES = "\x00-\x1b\x20-\x84\x86-ԯ‐-‧‰-⁞"


class PreTokens:
    """Cuts texts into pre-tokens and counts the pieces of one pre-token."""

    def __init__(self, path: str):
        import json

        import regex
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        added = spec.get("added_tokens") or []
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in added):
            raise ValueError("added tokens with strip, single-word or normalised matching are not supported")
        # Longest first, as the library matches.
        names = sorted((t["content"] for t in added), key=len, reverse=True)
        self.added = regex.compile("|".join(map(regex.escape, names))) if names else None
        self.names = frozenset(names)
        cutter = spec.get("pre_tokenizer") or {}
        self.normalizer = self.tokenizer.normalizer
        self.cutter = self.tokenizer.pre_tokenizer
        self.byte_level = (cutter.get("type") == "ByteLevel" and cutter.get("use_regex", True)
                           and not cutter.get("add_prefix_space") and self.normalizer is None)
        self.pattern = regex.compile(BYTE_LEVEL)
        self.other = regex.compile(f"[^{SAME_CLASSES}]")
        self.between_words = regex.compile(r"(?<=[a-z])(?= [a-z])")
        self.alphabet = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)

    def _parts(self, text: str) -> Iterator[str]:
        at = 0
        while self.byte_level and len(text) - at > 2 * PART:
            cut = self.between_words.search(text, at + PART)
            if not cut:
                break
            yield text[at:cut.start()]
            at = cut.start()
        yield text[at:] if at else text

    def _cut(self, text: str) -> Iterator[str]:
        if not self.byte_level:
            if self.normalizer:
                text = self.normalizer.normalize_str(text)
            return (piece for piece, _ in self.cutter.pre_tokenize_str(text)) if self.cutter else iter((text,))
        if self.other.search(text):
            return (text[s:e] for _, (s, e) in self.cutter.pre_tokenize_str(text))
        return iter(self.pattern.findall(text))

    def count(self, text: str) -> Counter:
        """Pre-tokens of the text with their frequencies; added tokens under their own string."""
        out: Counter = Counter()
        if self.added and self.added.search(text):
            names = self.added.findall(text)
            rest = self.added.split(text)
        else:
            names, rest = [], [text]
        for part in itertools.chain.from_iterable(map(self._parts, rest)):
            if part:
                out.update(self._cut(part))
        for name in names:
            out[ADDED + name] += 1
        return out

    def pieces(self, token: str) -> int:
        """Tokens that the model makes of one pre-token."""
        if token.startswith(ADDED) and token[len(ADDED):] in self.names:
            return 1
        if self.byte_level:
            return sum(len(self.tokenizer.model.tokenize(p)) for p, _ in self.alphabet.pre_tokenize_str(token))
        return len(self.tokenizer.model.tokenize(token))


#: Stands before an added token's string; no pre-token mixes a letter with NUL.
ADDED = "\x00a\x00"
_BLOCKS = "block long, tokens array<string>, doc_id array<long>, n_bytes array<long>, body binary"


def pack(kinds: np.ndarray, token: np.ndarray, freq: np.ndarray) -> bytes:
    """The documents' (token, frequency) lists in few bytes: the places of tokens, ascending within
    a document, as steps from one to the next, then compressed."""
    step = np.diff(token, prepend=0)
    first = np.concatenate([[0], np.cumsum(kinds)[:-1]])[kinds > 0]
    step[first] = token[first]
    raw = np.concatenate([[len(kinds)], kinds, step, freq]).astype("<i8")
    return len(raw).to_bytes(8, "little") + pa.Codec("zstd").compress(raw.tobytes(), asbytes=True)


def unpack(body: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(number of entries per document, places of tokens, frequencies) of :func:`pack`."""
    n = int.from_bytes(body[:8], "little")
    raw = np.frombuffer(pa.Codec("zstd").decompress(body[8:], decompressed_size=8 * n, asbytes=True), "<i8")
    kinds, rest = raw[1:raw[0] + 1], raw[raw[0] + 1:]
    step, freq = rest[:len(rest) // 2], rest[len(rest) // 2:]
    total = np.concatenate([[0], np.cumsum(step)])
    first = np.concatenate([[0], np.cumsum(kinds)[:-1]])
    return kinds, total[1:] - np.repeat(total[first], kinds), freq


def _blocks(path: str):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter = PreTokens(path)
        task = TaskContext.get()
        block = first = (task.partitionId() if task else 0) * BLOCKS
        held: list[tuple] = []
        place: dict[str, int] = {}
        size = 0

        def flush() -> pa.RecordBatch:
            nonlocal block, size
            ids, sizes, kinds, tokens, freqs = zip(*held, strict=True)
            row = [pa.array([block])] + [
                pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in (
                    pa.array(list(place), pa.string()), pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()))]
            kinds = np.array(kinds, np.int64)
            token, freq = (np.fromiter(itertools.chain.from_iterable(x), np.int64) for x in (tokens, freqs))
            order = np.lexsort((token, np.repeat(np.arange(len(kinds)), kinds)))
            row.append(pa.array([pack(kinds, token[order], freq[order])], pa.binary()))
            held.clear()
            place.clear()
            block, size = block + 1, 0
            return pa.RecordBatch.from_arrays(row, names=["block", "tokens", "doc_id", "n_bytes", "body"])

        for batch in batches:
            lengths = pc.binary_length(batch.column("text").cast(pa.large_string())).fill_null(0).to_pylist()
            ids = batch.column("doc_id").to_pylist()
            for i, n_bytes in enumerate(lengths):
                counts = cutter.count(batch.column("text")[i].as_py() or "")
                held.append((ids[i], n_bytes, len(counts), [place.setdefault(t, len(place)) for t in counts], list(counts.values())))
                size += n_bytes
                # Blocks grow in a partition of many GB, so that their numbers last.
                if size >= BLOCK_BYTES << (block - first) // (BLOCKS // 4):
                    yield flush()
        if held:
            yield flush()

    return cut


def _pieces(path: str):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter = PreTokens(path)
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column("token"), batch.column("n"), pa.array([cutter.pieces(t) for t in batch.column("token").to_pylist()], pa.int64())],
                names=["token", "n", "pieces"])

    return count


def _sums(kinds: np.ndarray, value: np.ndarray) -> np.ndarray:
    """Sum of each document's entries."""
    ends = np.cumsum(kinds)
    total = np.concatenate([[0], np.cumsum(value)])
    return (total[ends] - total[ends - kinds]).astype(np.int64)


def _known(shared):
    """Adds up what the shared table of frequent pre-tokens knows; the rest stays in the block."""
    def resolve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, counts = shared.value
        for batch in batches:
            for i in range(batch.num_rows):
                tokens = batch.column("tokens")[i].values
                place = pc.index_in(tokens, value_set=frequent).fill_null(-1).to_numpy(zero_copy_only=False)
                kinds, token, freq = unpack(batch.column("body")[i].as_py())
                rest = place[token] < 0
                known = _sums(kinds, np.where(rest, 0, counts[place[token]] * freq))
                left = place < 0
                body = pack(_sums(kinds, rest), (np.cumsum(left) - 1)[token[rest]], freq[rest])
                row = [pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in (
                    tokens.filter(pa.array(left)), batch.column("doc_id")[i].values, batch.column("n_bytes")[i].values, pa.array(known))]
                yield pa.RecordBatch.from_arrays([batch.column("block").slice(i, 1), *row, pa.array([body], pa.binary())],
                                                 names=["block", "tokens", "doc_id", "n_bytes", "known", "body"])

    return resolve


def _totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            ids, sizes, known, pieces = (batch.column(c)[i].values for c in ("doc_id", "n_bytes", "known", "pieces"))
            kinds, token, freq = unpack(batch.column("body")[i].as_py())
            value = (np.zeros(0, np.int64) if pieces is None else pieces.to_numpy())[token] * freq
            yield pa.RecordBatch.from_arrays([ids, sizes, pa.array(known.to_numpy() + _sums(kinds, value))],
                                             names=["doc_id", "n_bytes", "n_tokens"])


def count_tokens(docs: DataFrame, path: str, limit: int = 512) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` for each row of ``docs`` (doc_id, text).

    ``path`` is a file of the tokenizers library that every executor can open;
    ``over_limit`` says whether a document has more than ``limit`` tokens.
    """
    spark = docs.sparkSession
    blocks = materialise(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_blocks(path), _BLOCKS),
                         "pretokens")
    seen = blocks.select(F.explode("tokens").alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    pieces = materialise(seen.mapInArrow(_pieces(path), "token string, n long, pieces long"), "pieces")
    # At most FREQUENT strings of at most FREQUENT_BYTES bytes, however large the corpus.
    top = pieces.where(F.octet_length("token") <= FREQUENT_BYTES).orderBy(F.desc("n"), "token").limit(FREQUENT).toArrow()
    shared = spark.sparkContext.broadcast((top.column("token").combine_chunks(), np.append(top.column("pieces").to_numpy(), 0)))
    blocks = materialise(blocks.mapInArrow(_known(shared), _BLOCKS.replace("body", "known array<long>, body")), "rare")
    tokens = blocks.select("block", F.posexplode("tokens").alias("pos", "token")) \
        .select(F.expr("shiftleft(block, 31) + pos").alias("place"), "token")
    # (place in the block, pieces) in one long: a pre-token of a text has fewer than 2**32 pieces.
    counted = (join_spread(tokens, pieces.drop("n"), ["token"], ["place"])
               .select(F.expr("shiftright(place, 31)").alias("block"), F.expr("shiftleft(place & 2147483647L, 32) + pieces").alias("x"))
               .groupBy("block").agg(F.expr("transform(array_sort(collect_list(x)), x -> x & 4294967295L)").alias("pieces")))
    out = blocks.drop("tokens").join(counted, "block", "left").mapInArrow(_totals, "doc_id long, n_bytes long, n_tokens long")
    return out.withColumn("over_limit", F.col("n_tokens") > limit)
