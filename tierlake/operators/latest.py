"""Keep the latest row(s) per key — the batch form of
``DELETE ... WHERE (key, ts) NOT IN (SELECT key, max(ts) ... GROUP BY key)``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, key: str, order_col: str, alias: str | None = None) -> DataFrame:
    """``max(order_col)`` per ``key`` (NULL keys form one group)."""
    return df.groupBy(key).agg(F.max(order_col).alias(alias or f"max_{order_col}"))


def keep_latest(df: DataFrame, key: str, order_col: str) -> DataFrame:
    """Rows whose ``order_col`` equals their key's maximum; ties are all kept.

    A NULL ``order_col`` loses to any dated row of the same key; when every
    row of a key is undated, all of them are kept. NULL keys are one group.

    Planned as a partial aggregate joined back (null-safe) instead of a rank
    window: the aggregate combines map-side, so a key holding a third of the
    rows never has to be sorted in one task, and the per-key maxima — one row
    per key — are broadcast by AQE when they are small, so ``df`` itself is
    not shuffled.
    """
    m = latest_per_key(df, key, order_col, "__max").withColumnRenamed(key, "__key")
    joined = df.join(m, df[key].eqNullSafe(m["__key"]), "inner")
    keep = (F.col(order_col) == F.col("__max")) | F.col("__max").isNull()
    return joined.where(keep).drop("__key", "__max")
