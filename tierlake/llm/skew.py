"""Joins and top-k reports that stay even when one key holds a large part of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: No task gets much more than 1/PIECES of the rows of the larger side because of one key.
PIECES = 1024


def join_spread(left: DataFrame, right: DataFrame, keys: list[str], spread: list[str]) -> DataFrame:
    """Inner join of many rows (``left``) with one row per key (``right``).

    Keys that hold over ``1/PIECES`` of the left rows (fewer than ``PIECES`` of
    them, whatever the size, so they may be collected) are dealt over as many
    pieces as their share asks for, by a hash of the ``spread`` columns; their
    single right row is repeated once per piece. Rows with a NULL key match
    nothing. Give it materialised input: the left side is read twice.
    """
    spark = left.sparkSession
    counts = left.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).dropna(subset=keys)
    total = left.count()
    hot = counts.where(F.col("_n") * PIECES > total)
    found = hot.collect()
    if not found:
        return left.join(right, keys)
    hot = spark.createDataFrame(found, hot.schema).select(
        *keys, F.ceil(F.col("_n") * PIECES / F.lit(max(1, total))).cast("int").alias("_pieces"))
    dealt = (left.join(F.broadcast(hot), keys, "left")
             .withColumn("_piece", F.coalesce(F.pmod(F.xxhash64(*spread), "_pieces"), F.lit(0)).cast("int")).drop("_pieces"))
    copies = (right.join(F.broadcast(hot), keys, "left")
              .withColumn("_piece", F.explode(F.expr("sequence(0, coalesce(_pieces, 1) - 1)"))).drop("_pieces"))
    return dealt.join(copies, [*keys, "_piece"]).drop("_piece")


def top_per_group(df: DataFrame, group: list[str], order: list[Column], spread: list[str], k: int,
                  pieces: int = 256) -> DataFrame:
    """The first ``k`` rows of each group with their place as ``rank``.

    A group is first cut to ``k`` rows in each of ``pieces`` parts of it (by a hash
    of the ``spread`` columns), so the last window sees at most ``k * pieces`` rows a
    group however large it is. ``order`` should be a total order.
    """
    part = F.pmod(F.xxhash64(*spread), F.lit(pieces))
    first = (df.withColumn("_part", part)
             .withColumn("rank", F.row_number().over(Window.partitionBy(*group, "_part").orderBy(*order)))
             .where(F.col("rank") <= k).drop("_part", "rank"))
    return (first.withColumn("rank", F.row_number().over(Window.partitionBy(*group).orderBy(*order)))
            .where(F.col("rank") <= k))
