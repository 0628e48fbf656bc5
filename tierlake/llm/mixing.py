"""Mixing sources to target weights by Poisson replication.

A source with target weight w should fill the share w of the output. Its
documents then repeat at the mean rate w * total / n. The number of copies of a
document is the Poisson quantile at a hash of its id and the seed, so it needs
no state, no second pass and no random number generator: a retried task draws
the same copies.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierlake.llm.common import free_names, let, quoted, small_side, uniform

SEED, POWER = 42, 0.5
#: Larger rates are the sum of independent draws of equal rates up to this one.
MOST_RATE = 500.0
#: Sources up to which the table of rates is broadcast; beyond, the join shuffles.
BROADCAST_SOURCES = 20_000


def rates(docs: DataFrame, weights: DataFrame | None = None, power: float = POWER, total: int | None = None) -> DataFrame:
    """``source, rate``: the mean number of copies of a document of each source.

    ``weights`` has ``source, weight`` (a source that it lacks, or with a NULL or
    negative weight, has rate 0); without it a source of n documents weighs n ** power.
    ``total`` documents are the aim (default: as many as there are). NULL is a
    source like any other.
    """
    counts = docs.groupBy("source").agg(F.count("*").alias("n"))
    if weights is None:
        counts = counts.withColumn("weight", F.pow(F.col("n").cast("double"), F.lit(power)))
    else:
        aims = weights.select(F.col("source").alias("aim"), F.col("weight").cast("double").alias("weight")) \
            .groupBy("aim").agg(F.sum("weight").alias("weight"))
        counts = counts.join(aims, F.col("source").eqNullSafe(F.col("aim")), "left").select("source", "n", F.expr("greatest(coalesce(weight, 0D), 0D)").alias("weight"))
    sums = counts.agg(F.sum("weight").alias("all_weight"), F.sum("n").alias("all_n"))
    aim = F.lit(total).cast("long") if total is not None else F.col("all_n")
    return counts.crossJoin(F.broadcast(sums)).select(  # one row of sums
        "source", F.when(F.col("all_weight") > 0, F.col("weight") / F.col("all_weight") * aim / F.col("n")).otherwise(F.lit(0.0)).alias("rate"))


def poisson_table(rate: Column) -> Column:
    """The cumulative Poisson probabilities of 0, 1, 2 … as an array, up to far in the tail."""
    most = (rate + 12 * F.sqrt(rate) + 30).cast("int")
    zero = F.struct(F.exp(-rate).alias("p"), F.array(F.exp(-rate)).alias("c"))
    return F.aggregate(
        F.sequence(F.lit(1), most), zero,
        lambda s, k: F.struct((s["p"] * rate / k).alias("p"),
                              F.concat(s["c"], F.array(F.element_at(s["c"], -1) + s["p"] * rate / k)).alias("c")))["c"]


def replicate(docs: DataFrame, weights: DataFrame | None = None, power: float = POWER, total: int | None = None,
              seed: int = SEED) -> DataFrame:
    """``docs`` with each row as often as drawn, in a global random order, plus ``replica`` (1, 2 …).

    ``docs`` needs ``doc_id``, ``source`` and ``text``. All its columns stay, whatever their
    names; one named ``replica`` is replaced. Rows that share a doc_id get the same number of
    copies; rows without one draw by their text (a NULL text draws like one more text).
    A document drawn 0 times is absent: that is how a source above its target shrinks.
    A source may be NULL. An empty table gives an empty result. The texts move once, in the final shuffle,
    to a place that depends on id, text and copy, so equal ids don't meet in one task.
    """
    n_rate, n_plan, n_source, n_copies, n_place = free_names(docs, "rate", "plan", "plan_source", "copies", "place")
    plan = rates(docs, weights, power, total).withColumnRenamed("rate", n_rate) \
        .withColumn("pieces", F.greatest(F.lit(1), F.ceil(F.col(n_rate) / MOST_RATE).cast("int"))) \
        .withColumn("table", poisson_table(F.col(n_rate) / F.col("pieces"))) \
        .select(F.col("source").alias(n_source), F.struct("pieces", "table").alias(n_plan))
    kept = [F.col(quoted(c)) for c in docs.columns if c.lower() != "replica"]
    drawn = docs.join(small_side(plan, BROADCAST_SOURCES), F.col("source").eqNullSafe(F.col(n_source)))
    who = F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("text "), F.sha2(F.coalesce("text", F.lit("?")), 256)))
    copies = F.aggregate(
        F.sequence(F.lit(1), F.col(f"{n_plan}.pieces")), F.lit(0),
        lambda a, piece: a + let(uniform(seed, who, piece), lambda u: F.size(F.filter(F.col(f"{n_plan}.table"), lambda c: c <= u))))
    drawn = drawn.select(*kept, copies.alias(n_copies)).where(F.col(n_copies) > 0) \
        .select(*kept, F.explode(F.sequence(F.lit(1), F.col(n_copies))).alias("replica"))
    place = F.xxhash64(F.lit(seed), "doc_id", "replica", "text")
    return drawn.withColumn(n_place, place).repartition(n_place).sortWithinPartitions(n_place).drop(n_place)
