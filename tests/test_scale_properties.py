"""Skewed keys and conservation across layers."""

import datetime as dt

from pyspark.sql import functions as F

from tierlake.operators.latest import keep_latest
from tierlake.operators.merge import merge_plan
from tierlake.plans.layers import gold_daily_revenue, gold_trip_revenue, silver_transform
from tierlake.sources.fixtures import as_trips, read_table

from conftest import SF_SMALL


def test_hot_unmatched_key_holding_a_third_of_the_source(spark):
    n = 3000
    source = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("id"),
        F.col("id").cast("string").alias("v"))
    target = spark.range(n, 2 * n).select("id", F.lit("t").alias("v"))
    for strategy in ("broadcast", "shuffle"):
        r = merge_plan(target, source, ["id"], strategy=strategy)
        assert r.df.count() == 2 * n
        assert r.df.where("id = -1").count() == n // 3


def test_hot_key_keep_latest(spark):
    rows = [("hot", dt.datetime(2024, 1, 1) + dt.timedelta(seconds=i), i) for i in range(3000)]
    rows += [(f"f{i}", dt.datetime(2024, 1, 1), i) for i in range(10)]
    df = spark.createDataFrame(rows, "filename string, updated_date timestamp_ntz, n int")
    got = {r.filename: r.n for r in keep_latest(df, "filename", "updated_date").collect()}
    assert got["hot"] == 2999 and len(got) == 11


def test_revenue_conserved_across_layers(spark):
    bronze = as_trips(read_table(spark, SF_SMALL, "lineitem")).drop("airport_fee")
    silver = silver_transform(bronze)
    total = lambda df, c: round(df.agg(F.sum(c)).first()[0], 2)
    assert total(bronze, "total_amount") == total(silver, "total_amount") \
        == total(gold_trip_revenue(silver), "total_revenue") \
        == total(gold_daily_revenue(silver), "total_revenue")
    assert gold_daily_revenue(silver).agg(F.sum("trip_count")).first()[0] == bronze.count()
