"""The registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tierlake.llm import (
    collocations,
    lexical,
    minhash,
    mixing,
    pii,
    quality,
    quotes,
    rptree,
    tiling,
    token_counts,
    toxicity,
    url_filter,
    wavelet,
)
from tierlake.llm.common import table


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def op2_rp_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rptree.near_vectors(table(spark, sf_dir, "embeddings"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    benchmark = table(spark, sf_dir, "benchmark")
    return tiling.for_all_items(tiling.contaminated(table(spark, sf_dir, "documents"), benchmark), benchmark) \
        .selectExpr("doc_id", "item_id", "coverage", "tiles")


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"))


def op5_quote_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotes.link_quotes(table(spark, sf_dir, "conversations"))


def op6_wavelet_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = wavelet.new_shard_path(spark)
    wavelet.write_token_shards(table(spark, sf_dir, "documents"), tokenizer_path(), path)
    return wavelet.token_digests(spark, path)


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.replicate(table(spark, sf_dir, "documents"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), width=2)


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(table(spark, sf_dir, "documents"))


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents")).drop("doc_id")


QUERIES = {f.__name__: f for f in (op1_toxicity, op2_rp_forest, op3_decontamination, op4_url_filter, op5_quote_linking,
                                   op6_wavelet_shards, op7_mixing, op8_quality, op9_minhash, op10_pii,
                                   op11_lexical_search, op12_token_counts, op13_collocations)}

# Only A-Z are lower-cased, as the operators do.
_LOWER_SQL = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_TERMS_SQL = rf"unnest(regexp_extract_all({_LOWER_SQL}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'))"

# Components: every node with the least one that it reaches over ``edges`` (a, b), both ways.
_REACH_SQL = """reach AS (SELECT a AS node, a AS other FROM edges UNION SELECT r.node, e.b FROM reach r JOIN edges e ON r.other = e.a),
        least AS (SELECT node, min(other) AS component FROM reach GROUP BY node)"""

ORACLE_SQL: dict[str, str] = {
    "op2_rp_forest": f"""
        WITH RECURSIVE good AS (
            SELECT vec_id, label, list_transform(embedding, lambda v: v::DOUBLE) AS x FROM embeddings
            WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda v: v IS NULL OR NOT isfinite(v))) = 0
                AND len(list_filter(embedding, lambda v: v <> 0)) > 0),
        edges AS (SELECT p.vec_id AS a, q.vec_id AS b FROM good p JOIN good q ON p.label = q.label AND len(p.x) = len(q.x) AND p.vec_id <> q.vec_id
                  WHERE list_cosine_similarity(p.x, q.x) >= 0.93),
        {_REACH_SQL},
        links AS (SELECT a, count(*)::BIGINT AS n FROM edges GROUP BY a)
        SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, least(vec_id, coalesce(component, vec_id)) AS component_id,
               vec_id = least(vec_id, coalesce(component, vec_id)) AS kept
        FROM embeddings LEFT JOIN links ON vec_id = a LEFT JOIN least ON vec_id = node""",
    "op7_mixing": """
        WITH counts AS (SELECT source, count(*)::BIGINT AS n, sqrt(count(*)::DOUBLE) AS weight FROM documents GROUP BY source),
        rates AS (SELECT source, weight / (sum(weight) OVER ()) * (sum(n) OVER ()) / n AS rate FROM counts),
        steps AS (SELECT source, rate, k, exp(k * ln(rate) - lgamma(k + 1) - rate) AS p
                  FROM rates, LATERAL (SELECT unnest(generate_series(0, (rate + 12 * sqrt(rate) + 30)::INTEGER)) AS k)),
        tables AS (SELECT source, list(c ORDER BY k) AS c FROM (SELECT source, k, sum(p) OVER (PARTITION BY source ORDER BY k) AS c FROM steps) GROUP BY source),
        drawn AS (SELECT d.*, len(list_filter(c, lambda x: x <= ('0x' || substr(md5('42:' || doc_id || ':1'), 1, 13))::BIGINT::DOUBLE / 4503599627370496.0)) AS copies
                  FROM documents d JOIN tables t ON t.source IS NOT DISTINCT FROM d.source)
        SELECT * EXCLUDE (copies), unnest(generate_series(1, copies))::INTEGER AS replica FROM drawn""",
    "op9_minhash": rf"""
        WITH RECURSIVE words AS (SELECT doc_id, regexp_extract_all({_LOWER_SQL}, '[^\x20\x09-\x0D]+') AS w FROM documents),
        shingles AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 2 THEN list_transform(generate_series(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1])
                                                         WHEN len(w) = 1 THEN w ELSE [] END) AS s FROM words),
        sizes AS (SELECT doc_id, count(*)::BIGINT AS n FROM shingles GROUP BY doc_id),
        shared AS (SELECT p.doc_id AS a, q.doc_id AS b, count(*) AS common FROM shingles p JOIN shingles q ON p.s = q.s AND p.doc_id < q.doc_id GROUP BY ALL),
        found AS (SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * common >= 80 * (x.n + y.n - common)),
        edges AS (SELECT a, b FROM found UNION ALL SELECT b, a FROM found),
        {_REACH_SQL}
        SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, least(doc_id, coalesce(component, doc_id)) AS component_id,
               doc_id = least(doc_id, coalesce(component, doc_id)) AS kept
        FROM documents LEFT JOIN sizes USING (doc_id) LEFT JOIN least ON doc_id = node""",
    "op11_lexical_search": f"""
        WITH words AS (SELECT doc_id, {_TERMS_SQL} AS term FROM documents),
        tfs AS (SELECT doc_id, term, count(*)::BIGINT AS tf FROM words GROUP BY ALL),
        lens AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM tfs GROUP BY ALL),
        size AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS terms FROM lens),
        asked AS (SELECT item_id, term, count(*)::BIGINT AS times FROM (SELECT item_id, {_TERMS_SQL} AS term FROM benchmark) GROUP BY ALL),
        weights AS (SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
                    FROM tfs, size WHERE term IN (SELECT term FROM asked) GROUP BY term, docs),
        scores AS (SELECT item_id, doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // terms))))::BIGINT AS score
                   FROM asked JOIN tfs USING (term) JOIN weights USING (term) JOIN lens USING (doc_id), size GROUP BY ALL)
        SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM (
            SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scores WHERE score > 0)
        WHERE rank <= 20""",
    "op13_collocations": rf"""
        WITH pieces AS (SELECT lang, row_number() OVER () AS piece, piece_text FROM (
            SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex({_LOWER_SQL}, '[.,;:!?
-
]')) AS piece_text FROM documents)),
        lists AS (SELECT lang, regexp_extract_all(piece_text, '[^ 	]+') AS w FROM pieces),
        runs AS (SELECT lang, k, unnest(list_transform(generate_series(1, len(w) - k + 1), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase
                 FROM lists, (SELECT unnest([1, 2, 3]) AS k) WHERE len(w) >= k),
        f AS (SELECT lang, k, phrase, count(*)::BIGINT AS a FROM runs GROUP BY ALL),
        totals AS (SELECT lang, sum(a)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
        cand AS (SELECT lang, k, phrase, a, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND a >= 10),
        cuts AS (SELECT c.lang, c.phrase, c.a, cut, f1.a AS l, f2.a AS r,
                        ((1000000::HUGEINT * c.a * c.a) // (f1.a::HUGEINT * f2.a))::BIGINT AS score
                 FROM (SELECT *, unnest(generate_series(1, k - 1)) AS cut FROM cand) c
                 JOIN f f1 ON f1.lang = c.lang AND f1.phrase = array_to_string(c.w[1:cut], ' ')
                 JOIN f f2 ON f2.lang = c.lang AND f2.phrase = array_to_string(c.w[cut + 1:c.k], ' ')),
        lowest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
        longer AS (SELECT lang, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS phrase, a FROM cand WHERE k = 3),
        kept AS (SELECT * FROM lowest WHERE NOT EXISTS (SELECT 1 FROM longer WHERE longer.lang = lowest.lang AND longer.phrase = lowest.phrase
                                                        AND 100 * longer.a >= 50 * lowest.a))
        SELECT kept.lang, rank, phrase, a, l, r, n, score FROM (
            SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept) kept
        JOIN totals USING (lang) WHERE rank <= 2000""",
}
