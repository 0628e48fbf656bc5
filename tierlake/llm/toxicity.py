"""Toxicity grades by cumulative-link ordinal regression on sparse word features.

P(grade <= k) = sigmoid(t_k - w.x): one weight per word, shared by all ordered
thresholds t_0 <= t_1 <= … The features are words (64-bit hashes) that a document
holds; Spark counts them over the labelled rows and keeps those whose presence
depends most on the label.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierlake.llm.common import materialise, signed, small_side, uniform
from tierlake.llm.text import slices, words_of

#: Bound of the labelled sample that the model is fitted on (rows), and of its features.
FIT_ROWS, FEATURES = 20_000, 2_000
#: Labelled documents that must hold a word for it to be a feature.
LEAST_DOCS = 2


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(x / 2))


@dataclass
class OrdinalModel:
    words: np.ndarray  # sorted 64-bit hashes
    weights: np.ndarray
    thresholds: np.ndarray  # ascending

    @classmethod
    def fit(cls, words: np.ndarray, rows: np.ndarray, cols: np.ndarray, grades: np.ndarray,
            l2: float = 1e-4, steps: int = 400, rate: float = 0.1) -> OrdinalModel:
        """Maximum likelihood by Adam on the whole (bounded) sample.

        ``rows, cols``: the non-zero cells of the 0/1 feature matrix; ``grades`` from 0.
        The thresholds are a first one and positive gaps, so they stay ordered.
        """
        n, top = len(grades), int(grades.max(initial=0))
        if not n or not top:  # nothing, or only clean rows: nothing is toxic
            return cls(words, np.zeros(len(words)), np.full(1, 20.0))
        least = np.array([(grades <= k).mean() for k in range(top)]).clip(1e-6, 1 - 1e-6)
        start = np.log(least / (1 - least))
        x = np.concatenate([np.zeros(len(words)), start[:1], np.log(np.maximum(np.diff(start), 0.05))])
        m, v = np.zeros_like(x), np.zeros_like(x)
        for step in range(1, steps + 1):
            w, t = x[:len(words)], cls._ordered(x[len(words):])
            s = np.bincount(rows, w[cols], n)
            # The likelihood of grade g is F(t_g - s) - F(t_{g-1} - s).
            edges = np.concatenate([[-np.inf], t, [np.inf]])
            high, low = _sigmoid(edges[grades + 1] - s), _sigmoid(edges[grades] - s)
            p = np.maximum(high - low, 1e-12)
            d_high, d_low = high * (1 - high) / p, low * (1 - low) / p
            g_s = (d_high - d_low) / n
            g_t = np.zeros(top + 2)
            np.add.at(g_t, grades + 1, -d_high / n)
            np.add.at(g_t, grades, d_low / n)
            g_t = g_t[1:-1]
            gaps = np.exp(x[len(words) + 1:])
            g = np.concatenate([np.bincount(cols, g_s[rows], len(words)) + l2 * w,
                                [g_t.sum()], [g_t[k + 1:].sum() * gaps[k] for k in range(len(gaps))]])
            m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
            x = x - rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        return cls(words, x[:len(words)], cls._ordered(x[len(words):]))

    @staticmethod
    def _ordered(t: np.ndarray) -> np.ndarray:
        return np.concatenate([t[:1], t[0] + np.cumsum(np.exp(t[1:]))])

    def above(self, text: pa.Array) -> np.ndarray:
        """P(grade > k) for each text (rows) and threshold k (columns)."""
        _, _, _, hashes, first = words_of(text, plain=True)
        score = np.zeros(len(first) - 1)
        if len(self.words) and len(hashes):
            at = np.searchsorted(self.words, hashes).clip(0, len(self.words) - 1)
            hit = np.flatnonzero(self.words[at] == hashes)
            doc = np.searchsorted(first, hit, side="right") - 1
            cell = np.unique(doc * len(self.words) + at[hit])  # presence, not frequency
            score = np.bincount(cell // len(self.words), self.weights[cell % len(self.words)], len(score))
        return _sigmoid(score[:, None] - self.thresholds[None, :])


def _word_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The distinct words of each document, as hashes."""
    for batch in batches:
        for part in slices(batch):
            _, _, _, hashes, first = words_of(part.column("text"), plain=True)
            yield pa.record_batch([part.column("doc_id"), part.column("toxic"),
                                   pa.array([signed(np.unique(hashes[a:b])) for a, b in zip(first[:-1], first[1:], strict=True)],
                                            pa.list_(pa.int64()))], names=["doc_id", "toxic", "words"])


def fit(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS, features: int = FEATURES, grades: int = 3, seed: int = 42) -> OrdinalModel:
    """Fit severity grades 0 (clean) to ``grades`` from ``labels.toxic``.

    ``labels`` has ``doc_id, toxic`` (0, 1; NULL is unlabelled; a document with
    both labels counts as toxic). The labels tell only toxic or not, so a toxic
    row's grade comes from how many words typical of toxic rows it holds: the
    rows are cut at quantiles of that number. At most about ``fit_rows`` labelled
    documents, drawn by a hash of their id, are used.
    """
    marked = labels.where("toxic IS NOT NULL AND doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    n = marked.count()
    chosen = marked if n <= fit_rows else marked.where(uniform(seed, F.col("doc_id")) < fit_rows / n)
    # Bounded by fit_rows.
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .join(small_side(chosen, 2 * fit_rows), "doc_id")
    rows = materialise(rows.mapInArrow(_word_rows, "doc_id long, toxic int, words array<long>"), "labelled")
    total = {r[0]: r[1] for r in rows.groupBy("toxic").count().collect()}
    bad, good = total.get(1, 0), total.get(0, 0)
    if not bad:
        return OrdinalModel.fit(np.zeros(0, np.uint64), np.zeros(0, int), np.zeros(0, int), np.zeros(0, int))
    counts = rows.select("toxic", F.explode("words").alias("word")).groupBy("word") \
        .agg(F.sum("toxic").cast("double").alias("b"), F.sum(1 - F.col("toxic")).cast("double").alias("g")).where(f"b + g >= {LEAST_DOCS}")
    # Chi-square of presence against the label.
    all_ = float(bad + good)
    counts = counts.selectExpr("word", "b", "g", f"(b * ({good} - g) - g * ({bad} - b)) * (b * ({good} - g) - g * ({bad} - b)) * {all_} / "
                               f"((b + g) * ({all_} - b - g + 1) * {float(bad)} * {float(max(good, 1))}) AS chi")
    top = counts.orderBy(F.desc("chi"), "word").limit(features).toArrow()  # at most ``features`` rows
    words = top.column("word").to_numpy().view(np.uint64)
    typical = top.column("b").to_numpy() / bad > 4 * top.column("g").to_numpy() / max(good, 1)
    order = np.argsort(words)
    words, typical = words[order], typical[order]
    chosen_words = [int(w) for w in signed(words)]
    got = rows.select("doc_id", "toxic", F.array_intersect("words", F.lit(chosen_words)).alias("words")).orderBy("doc_id").toArrow()
    lists = got.column("words").combine_chunks()
    sizes = np.diff(lists.offsets.to_numpy())
    flat = np.searchsorted(words, lists.flatten().to_numpy().view(np.uint64))
    row = np.repeat(np.arange(len(sizes)), sizes)
    toxic = got.column("toxic").to_numpy()
    held = np.bincount(row, typical[flat], len(sizes))
    cuts = np.quantile(held[toxic == 1], np.arange(1, grades) / grades)
    grade = np.where(toxic == 1, 1 + np.searchsorted(np.unique(cuts), held, side="left"), 0)
    grade = np.searchsorted(np.unique(grade), grade)  # no empty grade
    return OrdinalModel.fit(words, row, flat, grade)


def score(docs: DataFrame, model: OrdinalModel, limit: float = 0.5) -> DataFrame:
    """Per row: ``doc_id``, ``severity`` (expected grade), ``grade`` (likeliest), ``p_toxic``, ``toxic`` (p_toxic >= limit).

    A NULL or empty text has no words and gets the model's base rate; a NULL
    doc_id stays NULL. Other columns are ignored. Repeated rows are scored alike.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("severity", pa.float64()), ("grade", pa.int32()), ("p_toxic", pa.float64()), ("toxic", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                above = model.above(part.column("text"))
                steps = np.concatenate([np.ones((len(above), 1)), above, np.zeros((len(above), 1))], axis=1)
                yield pa.record_batch([part.column("doc_id"), pa.array(above.sum(axis=1)),
                                       pa.array((-np.diff(steps, axis=1)).argmax(axis=1).astype(np.int32)),
                                       pa.array(above[:, 0]), pa.array(above[:, 0] >= limit)], schema=schema)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        run, "doc_id long, severity double, grade int, p_toxic double, toxic boolean")


def drop_toxic(docs: DataFrame, model: OrdinalModel, limit: float = 0.5) -> DataFrame:
    """``docs`` without the rows that ``score`` calls toxic; all columns stay, whatever their names."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                yield part.filter(pa.array(model.above(part.column("text"))[:, 0] < limit))

    # Plain names on the way, as Spark takes a dot in a name for a path there.
    plain = docs.toDF(*[c if c == "text" else f"c{k}" for k, c in enumerate(docs.columns)])
    return plain.mapInArrow(run, plain.schema).toDF(*docs.columns)
