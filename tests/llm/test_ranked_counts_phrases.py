"""Lexical search, token counts and collocations against brute force, hand-made hard
cases, and NULLs, empty and long texts, ties, repeated rows and clashing columns."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tierlake.llm import collocations, lexical, segments, skew, token_counts
from tierlake.llm.queries import tokenizer_path

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LOWER = {c: c + 32 for c in range(65, 91)}


def rows_of(spark, rows):
    """(doc_id, text, lang) rows with columns whose names the operators use inside."""
    return spark.createDataFrame([(i, t, la, "s", 0, 1, "x") for i, t, la in rows],
                                 DOCS + ", rank int, `a.b` string")


HARD = [(1, "a b c d e f g", "en"), (1, "a b c d e f g", "en"), (2, None, None), (3, "", "en"), (None, "a b c, D e", None),
        (4, "word " * 60_000, "en"), (5, "x" * 200_000, "en"), (6, "é ü 😀 ÀB mail a.b@c.de İ", "de"), (1, "another text", "en"),
        (7, "  \t, ;;\n\n", "fr"), (8, "one.two.one two\none two", "fr")]


# -- helpers ---------------------------------------------------------------


def test_segments_hold_whole_texts_and_cut_long_ones():
    import pyarrow as pa

    texts = ["", None, "ab cd", "x" * 40, "aa bb cc dd ee ff gg hh", "é" * 3, ""]
    cuts = np.zeros(256, bool)
    cuts[32] = True
    got = defaultdict(bytes)
    for raw, offsets, docs in segments.segments(pa.array(texts), cuts, 8):
        for k, d in enumerate(docs):
            got[int(d)] += raw[offsets[k]:offsets[k + 1]].tobytes()
            assert offsets[k + 1] - offsets[k] <= 9 or d == 3
    assert {i: (t or "").encode() for i, t in enumerate(texts)} == {i: got[i] for i in range(len(texts))}


def test_joins_with_a_hot_key_lose_and_repeat_nothing(spark, monkeypatch):
    monkeypatch.setattr(skew, "PIECES", 16)
    left = spark.range(3000).select(F.when(F.col("id") % 3 > 0, F.lit("hot")).when(F.col("id") % 7 > 0, F.col("id").cast("string")).alias("k"), "id")
    right = left.select("k").distinct().withColumn("v", F.xxhash64("k"))
    got = skew.join_spread(left, right, ["k"], ["id"]).collect()
    want = left.dropna(subset=["k"]).withColumn("v", F.xxhash64("k")).collect()
    assert sorted(got) == sorted(want)


def test_top_of_a_large_group(spark):
    df = spark.range(5000).select((F.col("id") % 50 == 0).cast("int").alias("g"), (F.col("id") % 9).alias("s"), "id")
    got = skew.top_per_group(df, ["g"], [F.desc("s"), F.asc("id")], ["id"], 7, pieces=5).collect()
    rows = sorted((r for r in df.collect()), key=lambda r: (r.g, -r.s, r.id))
    want = [(g, *x) for g in (0, 1) for x in [(r.s, r.id, k) for k, r in enumerate((r for r in rows if r.g == g), 1) if k <= 7]]
    assert sorted(tuple(r) for r in got) == sorted(want)


# -- 11 lexical search -----------------------------------------------------


def brute_search(docs, items, top=20):
    def terms(text):
        return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOWER))

    counts = [(i, Counter(terms(t))) for i, t in docs]
    counts = [(i, c) for i, c in counts if c]
    n_docs, total = len(counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for item, text in items:
        found = []
        for i, c in counts:
            m = 100 - 25 + 25 * sum(c.values()) * n_docs // total
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 12 * m))
                    for t in terms(text) if t in c)
            if s > 0:
                found.append((-s, i is None, i or 0))
        out += [(item, k, None if none else i, -s) for k, (s, none, i) in enumerate(sorted(found)[:top], 1)]
    return out


def keyed(rows):
    return sorted(rows, key=lambda r: tuple((x is None, x) for x in r))


def test_search_equals_brute_force_on_hard_texts(spark):
    draw = random.Random(3)
    words = ["A", "b", "C3", "delta", "épée", "zz" * 30, "zz" * 30 + "y", "longlongword", "longlongwore", "😀", "b"]
    docs = [(i, t) for i, t, _ in HARD] + [(100 + k // 2, draw.choice(" .,\n_").join(draw.choices(words, k=draw.randint(0, 30)))) for k in range(300)]
    items = [(1, "a b b c3 delta"), (1, "a b b c3 delta"), (2, None), (3, ""), (4, "word; WORD word épée"), (5, "zz" * 30 + " ÉPÉE épée"),
             (None, "longlongwore 😀"), (7, "nowhere"), (8, "!!"), (9, "x" * 200_000)]
    got = lexical.search(rows_of(spark, [(i, t, "en") for i, t in docs]),
                         spark.createDataFrame([(i, t, 3) for i, t in items], "item_id long, text string, rank int"))
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert keyed(tuple(r) for r in got.collect()) == keyed(brute_search(docs, items))


def test_search_in_blocks_of_items_and_small_tiles(spark, monkeypatch):
    for name, value in (("BLOCK_ITEMS", 4), ("TILE_DOCS", 7), ("TILE_TERMS", 3), ("PIECE_BYTES", 64)):
        monkeypatch.setattr(lexical, name, value)
    draw = random.Random(4)
    docs = [(k, " ".join(draw.choices("abcdefghij", k=draw.randint(1, 40)))) for k in range(200)]
    items = [(k, " ".join(draw.choices("abcdefghijkl", k=6))) for k in range(17)]
    got = lexical.search(rows_of(spark, [(i, t, "en") for i, t in docs]), spark.createDataFrame(items, "item_id long, text string"))
    assert sorted(tuple(r) for r in got.collect()) == sorted(brute_search(docs, items))


def test_weight_tiles_stay_exact():
    vocabulary = lexical.Vocabulary(["a " * 700_000 + "b", "a b"])
    tiles = lexical.weight_tiles(vocabulary, {0: 1, 1: 1}, 10**6, 2)
    limit = (lexical.EXACT - 1) // lexical.MAX_IMPACT
    w = math.floor(1000 * math.log((2 * 10**6 + 2) / 3))
    assert len(tiles) > 1 and all((weights.sum(0) <= limit).all() for _, weights in tiles)
    total = np.zeros((2, 2), np.int64)
    for columns, weights in tiles:
        assert len(set(columns)) == len(columns)
        total[columns] += weights.astype(np.int64)
    assert total.tolist() == [[700_000 * w, w], [w, w]]


def test_search_on_empty_tables(spark):
    docs, items = rows_of(spark, HARD), spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert lexical.search(docs.limit(0), items).count() == 0
    assert lexical.search(docs, items.limit(0)).count() == 0
    assert lexical.search(rows_of(spark, [(1, " .", "en")]), items).count() == 0


# -- 12 token counts -------------------------------------------------------


def brute_counts(name, rows):
    tokenizer = Tokenizer.from_file(tokenizer_path(name))
    return [(i, len((t or "").encode()), n := len(tokenizer.encode(t or "", add_special_tokens=False).ids), n > 512) for i, t, _ in rows]


def odd_texts(n, seed):
    draw = random.Random(seed)
    bits = ["a", "I'm", "they'LL", " ", "  ", "\n", "\n\n ", "\t", "12", "٣", "é", "ß", "漢字", "ไทย", "😀", "👩‍👩‍👧", "<|endoftext|>", "<|endoftext", " ", " ",
            "—", "’s", "'s", "x" * 50, "!?", "\x00", "\x1c", "\x85", "İ", "́", "ǆ", "ⅷ", "𝟘", "Ა"]
    return [(k, "".join(draw.choices(bits, k=draw.randint(0, 40))), "en") for k in range(n)]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_counts_equal_the_tokenizer(spark, name):
    rows = HARD + odd_texts(1500, 8) + [(None, "t", "en"), (1, "<|endoftext|><|endoftext|>", "en")]
    got = token_counts.count_tokens(rows_of(spark, rows), tokenizer_path(name))
    assert got.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    assert keyed(tuple(r) for r in got.collect()) == keyed(brute_counts(name, rows))


def test_counts_over_many_small_blocks_and_long_texts(spark, monkeypatch):
    monkeypatch.setattr(token_counts, "BLOCK_BYTES", 64)
    monkeypatch.setattr(token_counts, "PART", 100)
    monkeypatch.setattr(token_counts, "FREQUENT", 3)
    rows = odd_texts(80, 9) + [(900, "some plain words, and 12 more. " * 300, "en"), (901, "é漢 words and words " * 300, "en")]
    got = token_counts.count_tokens(rows_of(spark, rows), tokenizer_path("byte_bpe_50k.json"), limit=20)
    want = [(i, b, n, n > 20) for i, b, n, _ in brute_counts("byte_bpe_50k.json", rows)]
    assert sorted(tuple(r) for r in got.collect()) == sorted(want)
    assert got.limit(0).count() == 0 and token_counts.count_tokens(rows_of(spark, HARD).limit(0), tokenizer_path("byte_bpe_50k.json")).count() == 0


def test_both_cutters_agree_on_the_shared_characters():
    cutter = token_counts.PreTokens(tokenizer_path("byte_bpe_50k.json"))
    shared = [chr(c) for c in range(0x3000) if not cutter.other.search(chr(c))]
    assert len(shared) > 1000
    for c in shared:
        text = f"a{c}b 1{c}2 !{c}! {c} {c}{c}x  {c}9{c} '{c}"
        assert cutter.pattern.findall(text) == [text[s:e] for _, (s, e) in cutter.cutter.pre_tokenize_str(text)], hex(ord(c))


# -- 13 collocations -------------------------------------------------------


def brute_collocations(rows, longest=3, least=10, top=2000):
    n, f = Counter(), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, longest + 1):
                for i in range(len(words) - k + 1):
                    f[lang, tuple(words[i:i + k])] += 1
    candidates = {p: a for p, a in f.items() if len(p[1]) > 1 and a >= least}
    out = defaultdict(list)
    for (lang, p), a in candidates.items():
        if any(la == lang and len(q) > len(p) and 100 * b >= 50 * a and any(q[i:i + len(p)] == p for i in range(len(q)))
               for (la, q), b in candidates.items()):
            continue
        score, _, lo, hi = min((10**6 * a * a // (f[lang, p[:k]] * f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]]) for k in range(1, len(p)))
        out[lang].append((-score, -a, " ".join(p).encode(), lo, hi))
    return [(lang, k, p.decode(), -a, lo, hi, n[lang], -s) for lang, found in out.items()
            for k, (s, a, p, lo, hi) in enumerate(sorted(found)[:top], 1)]


def phrase_texts(n, seed):
    draw = random.Random(seed)
    words = ["a", "B", "c", "Éa", "éa", "x_1", "-", "zz", " ", "\x00"]
    return [(k % 40 if k % 11 else None, draw.choice([" ", "  ", "\t"]).join(draw.choices(words + [",", "\n", "a."], k=draw.randint(0, 25))),
             draw.choice(["en", "en", "de", None, "und", ""])) for k in range(n)]


@pytest.mark.parametrize("longest", [2, 3, 4])
def test_collocations_equal_brute_force(spark, longest):
    rows = HARD + phrase_texts(400, longest)
    got = collocations.collocations(rows_of(spark, rows), longest=longest)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score", "doc_id"]
    assert sorted(tuple(r)[:8] for r in got.collect()) == sorted(brute_collocations(rows, longest))


def test_collocations_with_colliding_fingerprints_and_tiny_parts(spark, monkeypatch):
    # Fingerprints of 5 bits collide all the time; the counts by text stay right.
    monkeypatch.setattr(collocations, "mix", lambda x, seed=0: x.astype(np.uint64) % np.uint64(31) + np.uint64(seed))
    monkeypatch.setattr(collocations, "PART_BYTES", 256)
    monkeypatch.setattr(collocations, "HELD", 4)
    rows = phrase_texts(150, 6)
    got = collocations.collocations(rows_of(spark, rows), top=5)
    assert sorted(tuple(r)[:8] for r in got.collect()) == sorted(brute_collocations(rows, top=5))


def test_pointers_are_the_least_documents_and_scores_pass_64_bits(spark):
    rows = [(9, "p q, " * 12, "en"), (4, "p q, z", "en"), (None, "p q", "en")]
    got = {r.phrase: r for r in collocations.collocations(rows_of(spark, rows)).collect()}
    assert got["p q"].doc_id == 4
    big = spark.createDataFrame([(10**13, 10**13 + 7, 10**13 + 9)], "a long, l long, r long")
    value = big.selectExpr("cast(1000000 * cast(a as decimal(15,0)) * cast(a as decimal(15,0)) as decimal(38,0)) "
                           "div cast(cast(l as decimal(15,0)) * cast(r as decimal(15,0)) as decimal(38,0)) AS s").first().s
    assert value == 10**6 * 10**26 // ((10**13 + 7) * (10**13 + 9))


def test_collocations_on_empty_tables(spark):
    assert collocations.collocations(rows_of(spark, HARD).limit(0)).count() == 0
    assert collocations.collocations(rows_of(spark, [(1, None, None), (2, " ., ", "en")])).count() == 0


def test_packed_lists_come_back():
    draw = np.random.default_rng(2)
    kinds = draw.choice([0, 0, 1, 40], 61)
    token = np.concatenate([np.sort(draw.choice(5000, k, replace=False)) for k in kinds])
    freq = draw.integers(1, 10**12, len(token))
    for got, want in zip(token_counts.unpack(token_counts.pack(kinds, token, freq)), (kinds, token, freq), strict=True):
        assert (got == want).all()
    assert [len(x) for x in token_counts.unpack(token_counts.pack(kinds[:1] * 0, token[:0], freq[:0]))] == [1, 0, 0]
