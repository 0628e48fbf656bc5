"""Shared helpers: reading tables, writing intermediate results, id filters."""

from __future__ import annotations

import ctypes
import gc
import math
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierlake.llm.text import mix


#: Rows that Python tasks get at once; texts are long, so far fewer than Spark's default.
BATCH_ROWS = 1000


def bound_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bound_batches(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``. Only a local session that names none
    gets one of its own; on a cluster an unset value is an error."""
    bound_batches(spark)
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set; point it at a shared folder")
        base = tempfile.mkdtemp(prefix="run-", dir="/tmp")
        spark.sparkContext.setCheckpointDir(base)
    return base.rstrip("/")


def materialise(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` once under the shared folder and read it back.

    This cuts lineage with files that all executors see, so a lost executor costs
    a re-read and not the work before it.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/llm/{purpose}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_side(df: DataFrame, max_rows: int) -> DataFrame:
    """``df`` marked for broadcasting if it has at most ``max_rows`` rows (counted),
    else unchanged, so that the join shuffles. Give it materialised or cheap input."""
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


def uniform(seed: int, *cols: Column) -> Column:
    """A number in [0, 1) from a hash of the columns and the seed (52 bits of MD5)."""
    text = F.concat_ws(":", F.lit(str(seed)), *[F.coalesce(c.cast("string"), F.lit("?")) for c in cols])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") / F.lit(float(2**52))


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once: an expression named inside a lambda is
    otherwise computed again for each element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def free_names(df: DataFrame, *names: str) -> list[str]:
    """The names, with underscores in front until no column of ``df`` is called like that."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        out.append(name)
    return out


def quoted(name: str) -> str:
    """A column name as Spark reads it literally, dots and all."""
    return "`" + name.replace("`", "``") + "`"


class KeyFilter:
    """A Bloom filter of 64-bit hashes: 16 bits a key, at most ``2**MOST_BITS`` bits (32 MB).

    Spark counts the keys and builds it (one partial OR per 64-bit word of the filter);
    the driver sees at most ``2**MOST_BITS / 64`` words whatever the number of keys. It only
    thins what is shuffled: an exact join or count follows, so a full filter costs time,
    never rows.
    """

    MOST_BITS = 28

    def __init__(self, spark: SparkSession, bits: np.ndarray):
        self.shared = spark.sparkContext.broadcast(bits)

    @classmethod
    def build(cls, hashes: DataFrame) -> KeyFilter:
        """From a table, materialised or cheap, whose first column is the hash, a long."""
        h = hashes.columns[0]
        log2_bits = min(cls.MOST_BITS, max(16, math.ceil(math.log2(16 * max(1, hashes.count())))))
        mask = (1 << log2_bits) - 1
        words = (hashes.select(F.explode(F.expr(f"array({h} & {mask}L, shiftrightunsigned({h}, 32) & {mask}L)")).alias("spot"))
                 .groupBy(F.expr("shiftright(spot, 6)").alias("word"))
                 .agg(F.expr("bit_or(shiftleft(1L, cast(spot % 64 as int)))").alias("bits")))
        got = words.toArrow()
        bits = np.zeros(1 << (log2_bits - 6), np.uint64)
        bits[got.column("word").to_numpy()] = got.column("bits").to_numpy().view(np.uint64)
        return cls(hashes.sparkSession, bits)

    def may_hold(self, hashes: np.ndarray) -> np.ndarray:
        """On an executor: which of the hashes may be in the filter."""
        bits = self.shared.value
        mask = np.uint64(len(bits) * 64 - 1)
        hit = np.ones(len(hashes), bool)
        for spot in (hashes & mask, (hashes >> np.uint64(32)) & mask):
            hit &= (bits[spot >> np.uint64(6)] >> (spot & np.uint64(63))) & np.uint64(1) == 1
        return hit

    def keep(self, df: DataFrame, column: str) -> DataFrame:
        """Rows of ``df`` whose hash in ``column`` may be in the filter."""
        def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                hashes = batch.column(column).to_numpy(zero_copy_only=False).view(np.uint64)
                yield batch.filter(pa.array(self.may_hold(hashes)))

        return df.where(F.col(column).isNotNull()).mapInArrow(test, df.schema)


def trim_memory() -> None:
    """On an executor: hand back what earlier tasks of this (reused) Python worker have freed."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it
    if trim is not None:
        trim(0)


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def combine(seed: int, columns: np.ndarray) -> np.ndarray:
    """One hash per row of a 2-D array of 64-bit values."""
    out = np.full(len(columns), seed, np.uint64)
    for k in range(columns.shape[1]):
        out = mix(out ^ columns[:, k], seed=k + 1)
    return out
