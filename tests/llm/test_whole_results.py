"""Fits against plain solvers, and the pipeline against a plain version of every stage."""

import hashlib
import math
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from conftest import SF_SMALL
from test_llm import brute_groups, brute_tiling
from tierlake.llm import mixing, quality, tiling, toxicity
from tierlake.llm.common import table
from tierlake.llm.queries import tokenizer_path


def test_ordinal_fit_reaches_the_likelihood_of_a_plain_search():
    draw = np.random.default_rng(4)
    x = (draw.random((600, 3)) < 0.4).astype(float)
    s = x @ np.array([2.0, -1.5, 0.5])
    grades = np.searchsorted([0.5, 1.8], s + draw.logistic(size=600))

    def loss(w, t):
        edges = np.concatenate([[-np.inf], t, [np.inf]])
        at = x @ w

        def cdf(v):
            return 1 / (1 + np.exp(-np.clip(v, -500, 500)))

        return -np.log(np.maximum(cdf(edges[grades + 1] - at) - cdf(edges[grades] - at), 1e-300)).mean()

    rows, cols = np.nonzero(x)
    model = toxicity.OrdinalModel.fit(np.arange(3, dtype=np.uint64), rows, cols, grades, l2=0.0, steps=1500)
    # Coordinate search from zero with ever smaller steps.
    best = np.array([0.0, 0.0, 0.0, 0.0, 1.0])
    value = loss(best[:3], best[3:])
    step = 1.0
    while step > 1e-5:
        moved = False
        for k in range(5):
            for sign in (1, -1):
                trial = best.copy()
                trial[k] += sign * step
                if trial[4] > trial[3] and (new := loss(trial[:3], trial[3:])) < value:
                    best, value, moved = trial, new, True
        step = step if moved else step / 2
    assert loss(model.weights, model.thresholds) <= value + 1e-4
    assert np.abs(model.weights - best[:3]).max() < 0.05 and np.abs(model.thresholds - best[3:]).max() < 0.05


def test_normal_equations_equal_those_of_one_machine(spark):
    docs, labels = table(spark, SF_SMALL, "documents"), table(spark, SF_SMALL, "labels")
    stats = quality.document_statistics(docs)
    model = quality.fit(stats, labels)
    marks = {r["doc_id"]: r["quality"] for r in labels.collect() if r["quality"] is not None}
    rows = [r for r in stats.collect() if r["doc_id"] in marks and zlib.crc32(str(r["doc_id"]).encode()) % 5]
    assert all(not r["held_out"] for r in rows)
    y = np.array([float(marks[r["doc_id"]]) for r in rows])
    z = model.features(np.array([r["stats"] for r in rows]))
    weight = np.where(y > 0, 0.5 / y.mean(), 0.5 / (1 - y.mean()))
    left = (z * weight[:, None]).T @ z + quality.RIDGE * len(y) * np.eye(z.shape[1]) / quality.FEATURES
    assert np.allclose(model.weights, np.linalg.solve(left, z.T @ (weight * y)), atol=1e-6)
    # The calibration ascends, and its levels are the mean labels of its blocks.
    assert (np.diff(model.levels) >= 0).all() and 0 <= model.levels[0] <= model.levels[-1] <= 1


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))


def test_pipeline_equals_a_plain_version(spark):
    docs = table(spark, SF_SMALL, "documents")
    rows = {r["doc_id"]: r for r in docs.collect()}
    # 1: the same model asked for one text at a time.
    model = toxicity.fit(docs, table(spark, SF_SMALL, "labels"))
    kept = [i for i, r in rows.items() if model.above(pa.array([r["text"]], pa.string()))[0, 0] < 0.5]
    assert 0 < len(kept) < len(rows)
    # 9: exact groups of five-word shingles.
    groups = brute_groups([(i, rows[i]["text"]) for i in kept], 5)
    kept = [i for i in kept if groups[i][1] == i]
    # 3: greedy tiling of every document that shares a window with an item.
    items = [words(r["text"]) for r in table(spark, SF_SMALL, "benchmark").collect()]

    def holds(text):
        tokens = words(text)
        windows = {tuple(tokens[k:k + 5]) for k in range(len(tokens) - 4)}
        for item in items:
            if any(tuple(item[k:k + 5]) in windows for k in range(len(item) - 4)):
                near = [k for k in range(len(tokens)) if any(tuple(tokens[j:j + 5]) in {tuple(item[i:i + 5]) for i in range(len(item) - 4)}
                                                             for j in range(max(0, k - 4), k + 1))]
                # Words outside any shared window can be in no tile: each gap becomes one word that no item has.
                short, last = [], -1
                for k in near:
                    short += ([None] if k != last + 1 else []) + [tokens[k]]
                    last = k
                if sum(n for _, _, n in brute_tiling(item, short, 5)) >= tiling.COVERAGE * len(item):
                    return True
        return False

    kept = [i for i in kept if not holds(rows[i]["text"])]
    # 7: Poisson quantiles, one document at a time.
    sources = {}
    for i in kept:
        sources[rows[i]["source"]] = sources.get(rows[i]["source"], 0) + 1
    weight = {s: n ** mixing.POWER for s, n in sources.items()}
    copies = []
    for i in kept:
        s = rows[i]["source"]
        rate = weight[s] / sum(weight.values()) * len(kept) / sources[s]
        u = int(hashlib.md5(f"{mixing.SEED}:{i}:1".encode()).hexdigest()[:13], 16) / 2**52
        p = c = math.exp(-rate)
        k = 0
        while c <= u:
            k += 1
            p *= rate / k
            c += p
        copies += [i] * k
    # 6: ids by the tokenizer itself.
    tokenizer = Tokenizer.from_file(tokenizer_path())
    want, start = [], 0
    for i in sorted(copies):
        ids = tokenizer.encode(rows[i]["text"] or "", add_special_tokens=False).ids + [2]
        want.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    out = corpus_pipeline.run(spark, SF_SMALL).select("doc_id", "start", "n_tokens", "ids_crc32")
    assert sorted(tuple(r) for r in out.collect()) == sorted(want) and len(want) > 50


def test_pipeline_reads_its_stages_back_and_keeps_clashing_columns(spark):
    docs = table(spark, SF_SMALL, "documents").limit(40).withColumns({"replica": F.lit("mine"), "a.b": F.lit(2), "component_id": F.lit(3)})
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF_SMALL)
        assert sorted(out.columns) == sorted(docs.columns), name
        assert {r[0] for r in out.select("replica").distinct().collect()} <= {"mine"}


def test_word_encoder_keeps_words_compactly():
    """A worker keeps its words' numbers through all later stages, so they must be small."""
    import tracemalloc

    import pyarrow as pa

    from tierlake.llm.queries import tokenizer_path
    from tierlake.llm.wavelet import END_ID, WordEncoder

    encoder, n = WordEncoder(tokenizer_path()), 150_000
    texts = [" ".join(f"w{k}x" for k in range(at, at + 1000)) for at in range(0, n, 1000)]
    expected = [[*e.ids, END_ID] for e in encoder.tokenizer.encode_batch(texts[:3], add_special_tokens=False)]
    WordEncoder(tokenizer_path()).encode(pa.array(texts[:10]), END_ID)  # the module's own tables
    tracemalloc.start()
    before = tracemalloc.get_traced_memory()[0]
    for k in range(0, len(texts), 10):
        encoder.encode(pa.array(texts[k:k + 10]), END_ID)
    kept = tracemalloc.get_traced_memory()[0] - before
    tracemalloc.stop()
    assert len(encoder.known) == n and kept < 60 * n
    ids, sizes = encoder.encode(pa.array(texts[:3]), END_ID)
    assert ids.tolist() == sum(expected, []) and sizes.tolist() == [len(e) for e in expected]
