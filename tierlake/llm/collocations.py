"""Collocations: phrases whose words keep together, per language.

Texts become arrays of word fingerprints, and every run of words gets its Rabin-Karp
fingerprint from the prefix polynomial of its text piece in numpy. A first pass counts words
and pairs by fingerprint alone; each further pass counts runs that are one word longer, and only
where both of their shorter runs were frequent (a run is never more frequent than its parts).
The shuffles add up ``(fingerprint, count, least doc_id with an occurrence)``.

The last pass goes over the texts again and verifies: an occurrence whose fingerprint is frequent
is traced back to its words' bytes (exactly, also where fingerprints collide) and only such phrases are
written out. Spark counts them by their text, so collisions cost time and never
change a number. Filters passed to tasks are Bloom filters of at most 2**28 bits,
sized by the counted keys; with more keys they only let more through.

Edge cases: NULL texts are empty, a NULL lang is ``und``; words keep all bytes but space and tab,
and no phrase crosses a document's or a piece's end. Repeated rows count as often as they
stand there. Equal scores are ranked by frequency, then by phrase in byte order. Very long texts are
read in parts cut at piece ends. Empty tables give an empty report.
Further columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tierlake.llm.common import KeyFilter, materialise, small_side
from tierlake.llm.segments import segments
from tierlake.llm.skew import join_spread, top_per_group
from tierlake.llm.text import _BASE, _BASE_INV, _LOWER, mix, powers, span_hashes

# Bytes that end a piece, and those that part words inside one.
_ENDS = np.zeros(256, bool)
_ENDS[list(b".,;:!?\x0a\x0b\x0c\x0d")] = True
_BETWEEN = _ENDS.copy()
_BETWEEN[list(b"\x20\x09")] = True
#: Text of one numpy pass; a task's counts are held for so many fingerprints.
PART_BYTES, HELD = 1 << 20, 700_000
#: Rows that go to Spark at once.
SENT = 100_000
NO_LANG = "und"


class Words:
    """The words of some segments: byte spans, fingerprints, languages and piece numbers."""

    def __init__(self, raw: np.ndarray, offsets: np.ndarray, docs: np.ndarray, langs: np.ndarray):
        inside = np.zeros(len(raw) + 2, bool)
        inside[1:-1] = ~_BETWEEN[raw]
        begins, ends = inside[1:-1] & ~inside[:-2], inside[1:-1] & ~inside[2:]
        cuts = offsets[1:-1]
        cuts = cuts[(cuts > 0) & (cuts < len(raw))]
        begins[cuts] |= inside[1:-1][cuts]
        ends[cuts - 1] |= inside[1:-1][cuts - 1]
        self.raw, self.starts, self.ends = raw, np.flatnonzero(begins), np.flatnonzero(ends) + 1
        segment = np.searchsorted(offsets, self.starts, side="right") - 1
        self.doc = docs[segment]
        self.lang = langs[self.doc]
        closed = np.cumsum(_ENDS[raw]) if len(raw) else np.zeros(0, np.int64)
        self.piece = (closed[self.starts] if len(self.starts) else np.zeros(0, np.int64)) + segment
        self.hashes = span_hashes(raw, self.starts, self.ends, lower=True)

    def runs(self, width: int) -> np.ndarray:
        """First word of every run of ``width`` words inside one piece."""
        n = max(0, len(self.starts) - width + 1)
        return np.flatnonzero(self.piece[:n] == self.piece[width - 1:width - 1 + n])

    def prints(self, width: int) -> np.ndarray:
        """Fingerprint of the run of ``width`` words at each word, languages apart.

        The polynomial's prefix sums over the word fingerprints give each run's value by
        one subtraction; the power of its place is divided out."""
        n = max(0, len(self.starts) - width + 1)
        prefix = np.zeros(len(self.hashes) + 1, np.uint64)
        with np.errstate(over="ignore"):
            np.cumsum(self.hashes * powers(_BASE, len(self.hashes)), out=prefix[1:])
            value = (prefix[width:] - prefix[:n]) * powers(_BASE_INV, len(self.hashes) + 1)[:n] if n else prefix[:0]
            return mix(value ^ mix(self.lang[:n].astype(np.uint64), seed=31), seed=width)


def _parts(batch: pa.RecordBatch) -> Iterator[tuple[Words, list[str]]]:
    """Words of the batch's texts with the languages' names; ``lang`` is a hash of the name there."""
    column = batch.column("lang").cast(pa.string()).fill_null(NO_LANG).dictionary_encode()
    names = column.dictionary.to_pylist()
    data = [x.encode() for x in names]
    ends = np.cumsum([len(d) for d in data]) if data else np.zeros(0, np.int64)
    marks = span_hashes(np.frombuffer(b"".join(data), np.uint8), ends - [len(d) for d in data], ends, lower=False) if data else np.zeros(0, np.uint64)
    langs = marks[column.indices.to_numpy()]
    of = column.indices.to_numpy()
    for raw, offsets, docs in segments(batch.column("text"), _ENDS, PART_BYTES):
        words = Words(raw, offsets, docs, langs)
        words.name = of[words.doc]
        yield words, names


class _Tally:
    """Counts and least pointers by fingerprint; handed on when too many are held."""

    def __init__(self):
        self.held: list[tuple[np.ndarray, ...]] = []
        self.rows = 0

    def add(self, keys: np.ndarray, docs: np.ndarray) -> None:
        if len(keys):
            self._put(keys, np.ones(len(keys), np.int64), docs)

    def _put(self, keys: np.ndarray, counts: np.ndarray, docs: np.ndarray) -> None:
        order = np.argsort(keys)
        keys, counts, docs = keys[order], counts[order], docs[order]
        at = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        self.held.append((keys[at], np.add.reduceat(counts, at), np.minimum.reduceat(docs, at)))
        self.rows += len(at)

    def _merged(self) -> tuple[np.ndarray, ...]:
        out = tuple(np.concatenate(x) for x in zip(*self.held, strict=True))
        self.held, self.rows = [], 0
        return out

    def full(self) -> bool:
        """Whether more than half of ``HELD`` fingerprints stay after merging what is held."""
        if self.rows > HELD:
            self._put(*self._merged())
            return self.rows > HELD // 2
        return False

    def take(self, width: int) -> Iterator[pa.RecordBatch]:
        if self.held:
            if len(self.held) > 1:
                self._put(*self._merged())
            keys, counts, docs = self._merged()
            for at in range(0, len(keys), SENT):
                k, c, d = (x[at:at + SENT] for x in (keys, counts, docs))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(k), width, np.int32)), pa.array(k.view(np.int64)),
                                                  pa.array(c), pa.array(d)], names=["width", "print", "n", "doc_id"])


_NO_ID = np.iinfo(np.int64).max


def _ids(batch: pa.RecordBatch) -> np.ndarray:
    """doc_id of the rows; the greatest number stands for NULL."""
    return batch.column("doc_id").cast(pa.int64()).fill_null(_NO_ID).to_numpy(zero_copy_only=False)


def _counter(widths: tuple[int, ...], shorter: KeyFilter | None) -> Callable:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tallies = {w: _Tally() for w in widths}
        for batch in batches:
            ids = _ids(batch)
            for words, _ in _parts(batch):
                for width, tally in tallies.items():
                    runs, prints = words.runs(width), words.prints(width)
                    if shorter is not None:
                        may = np.append(shorter.may_hold(words.prints(width - 1)), False)
                        runs = runs[may[runs] & may[runs + 1]]
                    tally.add(prints[runs], ids[words.doc[runs]])
                    if tally.full():
                        yield from tally.take(width)
        for width, tally in tallies.items():
            yield from tally.take(width)

    return count


def _frequent(docs: DataFrame, widths: tuple[int, ...], shorter: KeyFilter | None, least: int) -> DataFrame:
    rows = docs.mapInArrow(_counter(widths, shorter), "width int, print long, n long, doc_id long")
    return materialise(rows.groupBy("width", "print").agg(F.sum("n").alias("n"), F.min("doc_id").alias("doc_id"))
                       .where(F.col("n") >= least), "runs")


def _exact_words(words: Words) -> tuple[pa.Array, np.ndarray]:
    """The distinct words (lower-cased bytes) and each word's place among them, from the bytes themselves."""
    low = _LOWER[words.raw]
    offsets = np.stack([words.starts, words.ends], 1).ravel()
    spans = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(offsets) - 1 if len(offsets) else 0,
                                             [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(low.tobytes())])
    # Even places are the words, odd places the gaps between them.
    column = spans.take(pa.array(np.arange(0, len(spans), 2))).dictionary_encode()
    return column.dictionary, column.indices.to_numpy()


def _phrases(longest: int, frequent: KeyFilter) -> Callable:
    """Rows (lang, width, phrase, n, doc_id) of runs whose fingerprint may be frequent; width 0: all words of a language."""
    def trace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = _ids(batch)
            for words, names in _parts(batch):
                if not len(words.starts):
                    continue
                totals = np.bincount(words.name, minlength=len(names))
                yield _rows(names, np.flatnonzero(totals), 0, pa.array([""] * int((totals > 0).sum())), totals[totals > 0], None)
                distinct, of = _exact_words(words)
                code = np.zeros(0, np.int64)
                for width in range(1, longest + 1):
                    # The exact identity of a run: that of the run without its last word, and that word.
                    n = len(of) - width + 1
                    if n <= 0:
                        break
                    code = (words.name * np.int64(len(distinct)) + of) if width == 1 else code[:n] * np.int64(len(distinct)) + of[width - 1:]
                    code = np.unique(code, return_inverse=True)[1].astype(np.int64)
                    runs = words.runs(width)
                    runs = runs[frequent.may_hold(words.prints(width)[runs])]
                    if not len(runs):
                        continue
                    order = runs[np.argsort(code[runs], kind="stable")]
                    at = np.flatnonzero(np.concatenate([[True], code[order][1:] != code[order][:-1]]))
                    first = order[at]
                    text = pc.binary_join_element_wise(*[distinct.take(pa.array(of[first + k])) for k in range(width)],
                                                       pa.scalar(b" ", pa.large_binary())) if width > 1 else distinct.take(pa.array(of[first]))
                    counts = np.diff(np.append(at, len(order)))
                    yield _rows(names, words.name[first], width, text.cast(pa.large_string()).cast(pa.string()), counts,
                                np.minimum.reduceat(ids[words.doc[order]], at))

    return trace


def _rows(names: list[str], lang: np.ndarray, width: int, phrase: pa.Array, n: np.ndarray, docs: np.ndarray | None) -> pa.RecordBatch:
    docs = np.full(len(n), _NO_ID) if docs is None else docs
    return pa.RecordBatch.from_arrays([
        pa.array(names, pa.string()).take(pa.array(lang)), pa.array(np.full(len(n), width, np.int32)), phrase,
        pa.array(n.astype(np.int64)), pa.array(docs)], names=["lang", "width", "phrase", "n", "doc_id"])


def frequent_phrases(docs: DataFrame, longest: int = 3, least: int = 10) -> DataFrame:
    """(lang, width, phrase, n, doc_id): all runs of 1 to ``longest`` words that occur
    ``least`` times or more, and per language a row of width 0 with its number of words.
    ``doc_id`` is the least one that holds the phrase."""
    docs = docs.select("doc_id", "lang", "text")
    found = _frequent(docs, (1, 2), None, least)
    every, last = found, found.where("width = 2")
    for width in range(3, longest + 1):
        last = _frequent(docs, (width,), KeyFilter.build(last.select("print")), least)
        every = every.unionByName(last)
    rows = docs.mapInArrow(_phrases(longest, KeyFilter.build(every.select("print"))), "lang string, width int, phrase string, n long, doc_id long")
    return materialise(rows.groupBy("lang", "width", "phrase").agg(F.sum("n").alias("n"), F.min("doc_id").alias("doc_id"))
                       .where((F.col("n") >= least) | (F.col("width") == 0)), "phrases")


def _reaching(kept: DataFrame, top: int) -> DataFrame:
    """The rows whose score is high enough to be among the ``top`` of their language.

    Scores lie between 0 and a million, so a language has a thousand ranges of them at most; their
    sizes tell the range in which the last place falls, and lower ones drop out before any sort."""
    ranges = kept.groupBy("lang", F.expr("score div 1000").alias("range")).agg(F.count(F.lit(1)).alias("rows"))
    above = F.sum("rows").over(Window.partitionBy("lang").orderBy(F.desc("range"))) - F.col("rows")
    least = ranges.withColumn("above", above).where(F.col("above") < top).groupBy("lang").agg(F.min("range").alias("least"))
    return kept.join(small_side(least, 10_000), "lang").where(F.expr("score div 1000 >= least")).drop("least")


def collocations(docs: DataFrame, longest: int = 3, least: int = 10, inside_percent: int = 50, top: int = 2000) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score, doc_id`` of each language's best phrases.

    ``a`` is the phrase's frequency; of all cuts in two the lowest-scoring one counts (ties: the
    first), with the frequencies ``l`` and ``r`` of its parts and
    ``score = floor(1000000 * a * a / (l * r))``, in exact decimals. A phrase inside a longer frequent one
    that has at least ``inside_percent`` of its frequency is left out. ``n`` counts the
    language's words. ``docs`` has doc_id, lang and text.
    """
    known = frequent_phrases(docs, longest, least)
    counts = known.where("width > 0").select("lang", "phrase", "n")
    candidates = known.where("width > 1").select("lang", "phrase", "width", F.col("n").alias("a"), "doc_id")
    words = F.split("phrase", " ", -1)
    cuts = candidates.select("lang", "phrase", "a", F.explode(F.expr("sequence(1, width - 1)")).alias("k"), words.alias("w")).select(
        "lang", "phrase", "a", "k", F.expr("array_join(slice(w, 1, k), ' ')").alias("left"),
        F.expr("array_join(slice(w, k + 1, size(w) - k), ' ')").alias("right"))
    cuts = materialise(cuts, "cuts")
    for part, name in (("left", "l"), ("right", "r")):
        cuts = materialise(join_spread(cuts, counts.select("lang", F.col("phrase").alias(part), F.col("n").alias(name)),
                                       ["lang", part], ["phrase", "k"]), "cuts")
    scored = cuts.select("lang", "phrase", "k", "l", "r", F.expr(
        "cast(1000000 * cast(a as decimal(15,0)) * cast(a as decimal(15,0)) as decimal(38,0)) "
        "div cast(cast(l as decimal(15,0)) * cast(r as decimal(15,0)) as decimal(38,0))").alias("score"))
    lowest = scored.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    inner = candidates.where("width > 2").select(
        "lang", "a", F.explode(F.expr(
            "flatten(transform(sequence(2, width - 1), m -> transform(sequence(1, width - m + 1), "
            "s -> array_join(slice(split(phrase, ' ', -1), s, m), ' '))))")).alias("phrase"))
    covered = inner.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    kept = (candidates.join(covered, ["lang", "phrase"], "left")
            .where(F.col("longer").isNull() | (100 * F.col("longer") < inside_percent * F.col("a")))
            .join(lowest, ["lang", "phrase"]))
    kept = materialise(kept.select("lang", "phrase", "a", "doc_id", "cut.score", "cut.l", "cut.r"), "kept")
    best = top_per_group(_reaching(kept, top), ["lang"], [F.desc("score"), F.desc("a"), F.asc("phrase")], ["phrase"], top)
    totals = known.where("width = 0").select("lang", "n")
    return best.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score",
        F.when(F.col("doc_id") < _NO_ID, F.col("doc_id")).alias("doc_id"))
