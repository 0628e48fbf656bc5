"""Surrogate key, conformance, layer transforms, gold aggregates."""

import datetime as dt
import hashlib

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from tierlake.functions.keys import surrogate_key
from tierlake.operators.conform import SchemaMismatch, conform
from tierlake.plans.layers import (
    bronze_batch,
    gold_daily_revenue,
    gold_trip_revenue,
    silver_transform,
    top_rows,
)
from tierlake.schemas import BRONZE_SCHEMA, SILVER_SCHEMA
from tierlake.sources.fixtures import as_trips, read_table

from conftest import SF_SMALL


def test_key_skips_nulls_by_default(spark):
    df = spark.createDataFrame([("a", None, "b"), ("a", "b", None), (None, None, None)],
                               "x string, y string, z string")
    plain = [r.k for r in df.select(surrogate_key("x", "y", "z").alias("k")).collect()]
    assert plain[0] == plain[1] == hashlib.sha256(b"a||b").hexdigest()
    assert plain[2] == hashlib.sha256(b"").hexdigest()
    marked = [r.k for r in df.select(surrogate_key("x", "y", "z", null_token="\\N").alias("k"))
              .collect()]
    assert marked[0] != marked[1]


def test_trip_id_ignores_session_zone(spark):
    bronze = as_trips(read_table(spark, SF_SMALL, "lineitem")).drop("airport_fee")
    ids = {}
    for zone in ("UTC", "Asia/Ho_Chi_Minh"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        ids[zone] = sorted(r.trip_id for r in silver_transform(bronze).select("trip_id").collect())
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert ids["UTC"] == ids["Asia/Ho_Chi_Minh"]


def test_trip_id_independent_of_partitioning(spark):
    bronze = as_trips(read_table(spark, SF_SMALL, "lineitem")).drop("airport_fee")
    a = silver_transform(bronze).select("trip_id")
    b = silver_transform(bronze.repartition(7, "payment_type")).select("trip_id")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_conform_overflow_raises(spark, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        df = spark.createDataFrame([(1, 30_000_000_000)], "a long, VendorID long")
        with pytest.raises(Exception, match="out of range|OVERFLOW"):
            conform(df.select("VendorID"), StructType([SILVER_SCHEMA["VendorID"]])).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


def test_conform_fills_drops_and_truncates(spark):
    df = spark.createDataFrame([(2.9, "x", 7)], "vendorid double, extra string, b long")
    schema = StructType([StructField("VendorID", IntegerType()),
                         StructField("b", LongType()), StructField("c", DoubleType())])
    with pytest.raises(SchemaMismatch):
        conform(df, schema)
    out = conform(df, schema, fill_missing=True).collect()[0]
    assert (out.VendorID, out.b, out.c) == (2, 7, None)
    with pytest.raises(SchemaMismatch):
        conform(df, schema, fill_missing=True, drop_extra=False)


def test_bronze_batch_has_bronze_schema(spark):
    raw = as_trips(read_table(spark, SF_SMALL, "lineitem"))
    b = bronze_batch(raw, "b1", dt.datetime(2024, 1, 1))
    assert [(f.name, f.dataType) for f in b.schema] == \
        [(f.name, f.dataType) for f in BRONZE_SCHEMA]
    r = b.select("batch_id", "updated_date", "ingested_date", "passenger_count").first()
    assert r.batch_id == "b1" and r.updated_date == dt.datetime(2024, 1, 1)
    assert r.passenger_count is None


def test_gold_per_trip_and_per_day(spark):
    ts = dt.datetime
    silver = spark.createDataFrame(
        [("t1", ts(2024, 1, 1, 1), 10.0), ("t1", ts(2024, 1, 1, 2), 5.0),
         ("t2", ts(2024, 1, 1, 3), 1.25), ("t3", ts(2024, 1, 2, 3), 2.0)],
        StructType([StructField("trip_id", StringType()),
                    StructField("dropoff_datetime", SILVER_SCHEMA["dropoff_datetime"].dataType),
                    StructField("total_amount", DoubleType())]))
    per_trip = {(r.id, r.day): r.total_revenue for r in gold_trip_revenue(silver).collect()}
    assert per_trip == {("t1", 1): 15.0, ("t2", 1): 1.25, ("t3", 2): 2.0}
    daily = {r.day: (r.total_revenue, r.trip_count) for r in gold_daily_revenue(silver).collect()}
    assert daily == {1: (16.25, 3), 2: (2.0, 1)}


def test_top_rows_is_a_top_k(spark):
    df = spark.range(1000).select(F.col("id").cast("string").alias("id"))
    plan = top_rows(df, 10)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan
    assert [r.id for r in top_rows(df, 3).collect()] == ["0", "1", "10"]
