"""Document quality by ridge regression on random Fourier features.

A document becomes a few statistics of its bytes, words and lines. Cosines of
random projections of them approximate a Gaussian kernel; ridge scores come from
normal equations summed per partition; isotonic regression turns scores into
probabilities.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierlake.llm.common import materialise
from tierlake.llm.text import buffer_of, rolling, slices, span_hashes, word_bounds

STATS = ["log_bytes", "log_words", "word_bytes", "upper", "digits", "marks", "symbols", "spaces", "high",
         "repeats", "distinct", "distinct_triples", "capital_words", "line_words", "repeated_lines", "marked_words"]
FEATURES, RIDGE, WIDTH = 256, 1e-3, 1.0
#: Partitions that the normal equations are summed in.
PARTS = 64
#: Score steps that the calibration counts labels in.
STEPS = 2000

_UPPER, _DIGIT, _MARK, _SYMBOL, _SPACE, _HIGH, _LETTER = (np.zeros(256, bool) for _ in range(7))
_UPPER[65:91] = True
_DIGIT[48:58] = True
_MARK[[ord(c) for c in ".,;:?'\"()-"]] = True
_SYMBOL[[ord(c) for c in "!#$%&*+/<=>@[\\]^_`{|}~"]] = True
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_HIGH[128:] = True
_LETTER[[c for c in range(256) if c >= 128 or chr(c).isalpha()]] = True


def statistics(text: pa.Array) -> np.ndarray:
    """One row of ``STATS`` per text (NULL counts as empty; an empty text is all zeros)."""
    raw, offsets = buffer_of(text)
    n = len(offsets) - 1
    size = np.diff(offsets)
    starts, ends = word_bounds(raw, offsets)
    hashes = span_hashes(raw, starts, ends, lower=True)
    first = np.searchsorted(starts, offsets)
    words = np.diff(first)

    def per_doc(flags: np.ndarray, at: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
        return (total[at[1:]] - total[at[:-1]]).astype(float)

    def share(kind: np.ndarray) -> np.ndarray:
        return per_doc(kind[raw], offsets) / np.maximum(size, 1)

    doc = np.repeat(np.arange(n), words)
    repeats = np.zeros(len(hashes), bool)
    repeats[1:] = (hashes[1:] == hashes[:-1]) & (doc[1:] == doc[:-1])
    triples = rolling(hashes, 3)
    distinct, distinct_triples, line_share = np.zeros(n), np.zeros(n), np.zeros(n)
    breaks = np.flatnonzero(raw == 10)
    line_starts = np.unique(np.concatenate([offsets[:-1], breaks + 1]))
    line_starts = line_starts[line_starts < len(raw)]
    line_ends = np.concatenate([line_starts[1:], [len(raw)]]) if len(line_starts) else line_starts
    line_hashes = span_hashes(raw, line_starts, line_ends, lower=False)
    line_first = np.searchsorted(line_starts, offsets)
    lines = np.diff(line_first)
    for d in range(n):
        a, b = first[d], first[d + 1]
        if b > a:
            distinct[d] = len(np.unique(hashes[a:b])) / (b - a)
            distinct_triples[d] = len(np.unique(triples[a:b - 2])) / (b - a - 2) if b - a > 2 else 1
        if lines[d] > 1:
            line_share[d] = 1 - len(np.unique(line_hashes[line_first[d]:line_first[d + 1]])) / lines[d]
    some = np.maximum(words, 1)
    last_symbol = _SYMBOL[raw[ends - 1]] if len(ends) else np.zeros(0, bool)
    return np.stack([
        np.log1p(size), np.log1p(words), per_doc(_LETTER[raw], offsets) / some, share(_UPPER), share(_DIGIT), share(_MARK), share(_SYMBOL),
        share(_SPACE), share(_HIGH), per_doc(repeats, first) / some, distinct, distinct_triples,
        per_doc(_UPPER[raw[starts]], first) / some, words / np.maximum(lines, 1), line_share, per_doc(last_symbol, first) / some], axis=1)


def document_statistics(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, stats`` of each row; ``held_out``: crc32 of the id as text is divisible by 5
    (false for a NULL id). Other columns are ignored."""
    schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("stats", pa.list_(pa.float64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                got = statistics(part.column("text"))
                flat = pa.ListArray.from_arrays(pa.array(np.arange(len(got) + 1) * len(STATS), pa.int32()), pa.array(got.ravel()))
                yield pa.record_batch([part.column("doc_id"), part.column("held_out"), flat], schema=schema)

    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .select("doc_id", held_out.alias("held_out"), "text").mapInArrow(run, "doc_id long, held_out boolean, stats array<double>")


@dataclass
class QualityModel:
    mean: np.ndarray
    scale: np.ndarray
    projection: np.ndarray
    phase: np.ndarray
    weights: np.ndarray
    steps: np.ndarray  # upper score of each level
    levels: np.ndarray  # calibrated probability of each level, ascending

    def features(self, stats: np.ndarray) -> np.ndarray:
        x = np.clip((stats - self.mean) / self.scale, -8, 8)
        z = np.cos(x @ self.projection + self.phase) * np.sqrt(2 / self.projection.shape[1])
        return np.concatenate([z, np.ones((len(z), 1))], axis=1)

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return self.features(stats) @ self.weights

    def score(self, stats: np.ndarray) -> np.ndarray:
        return np.interp(self.raw(stats), self.steps, self.levels)


def isotonic(score: np.ndarray, good: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Ascending fit of the shares ``good / n`` (pool adjacent violators), ``score`` ascending."""
    blocks: list[list[float]] = []
    for g, m in zip(good.tolist(), n.tolist(), strict=True):
        blocks.append([g, m, 1])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            g2, m2, k2 = blocks.pop()
            blocks[-1] = [blocks[-1][0] + g2, blocks[-1][1] + m2, blocks[-1][2] + k2]
    return np.concatenate([np.full(int(k), g / m) for g, m, k in blocks])


def _stack(column) -> np.ndarray:
    return np.array(column.to_list() if hasattr(column, "to_list") else column.to_pylist(), float).reshape(-1, len(STATS))


def fit(stats: DataFrame, labels: DataFrame, features: int = FEATURES, ridge: float = RIDGE, width: float = WIDTH, seed: int = 42) -> QualityModel:
    """Fit on the rows of ``stats`` that are not held out and whose id has a label.

    ``labels`` has ``doc_id, quality`` (0, 1; NULL: unlabelled; several labels of an
    id: their mean, from 0.5 up good). All labelled rows count: each of ``PARTS``
    partitions sums its part of the normal equations, and their rows are added up
    by Spark, so the driver gets one matrix of ``features`` squared. Without rows
    of both labels the score is the share of good labels (0.5 without any).
    """
    marks = labels.where("quality IS NOT NULL AND doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id")) \
        .agg((F.avg("quality") >= 0.5).cast("double").alias("y"))
    # One row for an id: repeated ids would count one label more than once.
    rows = stats.where("NOT held_out").join(marks, "doc_id").groupBy("doc_id").agg(F.min("stats").alias("stats"), F.first("y").alias("y"))
    rows = materialise(rows.select("stats", "y").repartition(PARTS, F.xxhash64("doc_id")), "labelled")
    columns = [F.get("stats", F.lit(k)) for k in range(len(STATS))]
    got = rows.agg(F.count("*"), F.coalesce(F.sum("y"), F.lit(0.0)), *[F.avg(c) for c in columns], *[F.stddev_pop(c) for c in columns]).first()
    n, good = got[0], got[1]
    draw = np.random.default_rng(seed)
    projection = draw.normal(size=(len(STATS), features)) / (width * np.sqrt(len(STATS)))
    phase = draw.uniform(0, 2 * np.pi, features)
    if not 0 < good < n:
        level = good / n if n else 0.5
        return QualityModel(np.zeros(len(STATS)), np.ones(len(STATS)), projection, phase, np.zeros(features + 1), np.zeros(1), np.full(1, level))
    mean = np.array(got[2:2 + len(STATS)])
    scale = np.array(got[2 + len(STATS):])
    model = QualityModel(mean, np.where(scale > 1e-9, scale, 1.0), projection, phase, np.zeros(features + 1), np.zeros(1), np.zeros(1))
    share = good / n

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((features + 1, features + 2))
        for batch in batches:
            z, y = model.features(_stack(batch.column("stats"))), batch.column("y").to_numpy()
            weight = np.where(y > 0, 0.5 / share, 0.5 / (1 - share))  # both labels weigh the same
            total[:, :-1] += z.T @ (z * weight[:, None])
            total[:, -1] += z.T @ (weight * y)
        yield pa.record_batch([pa.array(np.arange(features + 1)), pa.array(list(total), pa.list_(pa.float64()))], names=["row", "part"])

    def add(rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"row": rows["row"].iloc[:1], "total": [np.sum(np.stack(rows["part"].to_list()), axis=0)]})

    # At most PARTS arrays for each matrix row.
    total = rows.mapInArrow(sums, "row long, part array<double>").groupBy("row").applyInPandas(add, "row long, total array<double>").orderBy("row").toPandas()
    equations = np.stack(total["total"].to_list())
    model.weights = np.linalg.solve(equations[:, :-1] + ridge * n * np.eye(features + 1) / features, equations[:, -1])

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = np.clip(model.raw(_stack(batch.column("stats"))), -1, 2)
            yield pa.record_batch([pa.array(np.round(raw * STEPS / 3).astype(np.int64)), batch.column("y")], names=["step", "y"])

    counts = rows.mapInArrow(scored, "step long, y double").groupBy("step").agg(F.sum("y").alias("good"), F.count("*").alias("n")).orderBy("step").toPandas()
    steps = counts["step"].to_numpy() * 3 / STEPS
    model.steps, model.levels = steps, isotonic(steps, counts["good"].to_numpy(), counts["n"].to_numpy())
    return model


def score(stats: DataFrame, model: QualityModel, limit: float = 0.3) -> DataFrame:
    """``doc_id, held_out, score, predicted`` (1 if score >= limit) of each row of ``stats``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = model.score(_stack(batch.column("stats")))
            yield pa.record_batch([batch.column("doc_id"), batch.column("held_out"), pa.array(got), pa.array((got >= limit).astype(np.int32))],
                                  names=["doc_id", "held_out", "score", "predicted"])

    return stats.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def quality(docs: DataFrame, labels: DataFrame, limit: float = 0.3) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row of ``docs`` (doc_id, text).

    The text is read once, its statistics are written and used for fit and score.

    - A NULL or empty text has statistics of zero and is scored by them; a NULL doc_id stays NULL and
      is not held out. Rows with equal text get equal scores; rows that repeat an id are all returned,
      and count once in the fit.
    - Very long texts are read whole. Other columns are ignored. An empty table gives an empty result.
    """
    stats = materialise(document_statistics(docs), "stats")
    return score(stats, fit(stats, labels), limit)
