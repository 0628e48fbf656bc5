"""Corpus pipeline: documents → no toxic ones → one of each near-duplicate group →
no benchmark passages → mixed to target weights → token-id shards.

Each stage takes ``(spark, docs, sf_dir)``; its result is written as Parquet and
read again as the next stage's ``docs``. All but the last return the columns of
``documents``, further ones included.

Edge cases, in every stage: NULLs may stand in any column; an empty table gives an empty one;
very long texts are read whole; rows that repeat are judged alike, each for itself.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from tierlake.llm import minhash, mixing, tiling, toxicity, wavelet
from tierlake.llm.common import free_names, quoted, shared_folder, table
from tierlake.llm.queries import tokenizer_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose expected severity is below the limit; NULL and empty texts stay."""
    return toxicity.drop_toxic(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of least id of each group of near copies (five words, 0.8).

    Rows without text link with nothing and stay, as do rows without an id; rows that repeat a kept id all stay."""
    return minhash.drop_near_duplicates(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item; NULL and empty texts hold none."""
    return tiling.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as drawn, in random order. Equal ids draw alike; rows without an id draw by
    their text; a NULL source is one more source. A column ``replica`` of the input stays as it was."""
    kept, = free_names(docs, "kept_replica")
    had = [c for c in docs.columns if c.lower() == "replica"]
    drawn = mixing.replicate(docs.withColumnsRenamed({c: kept for c in had})).drop("replica")
    return drawn.withColumnsRenamed({kept: c for c in had}).select(*[quoted(c) for c in docs.columns])


def token_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Digests of the documents' token ids, read back from the shards; a NULL text has the end id only."""
    path = wavelet.new_shard_path(spark)
    wavelet.write_token_shards(docs, tokenizer_path(), path)
    return wavelet.token_digests(spark, path)


STAGES = [("toxicity", drop_toxic), ("near_duplicates", drop_near_duplicates), ("decontamination", drop_benchmark),
          ("mixing", mix_sources), ("token_shards", token_shards)]

#: The models, hashes and tokenizer have no SQL form; tests hold the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = f"{shared_folder(spark)}/llm/stage-{name}-{uuid.uuid4().hex}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
