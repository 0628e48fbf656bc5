"""Stored layers hold what a query over the layer below gives."""

import datetime as dt
import glob
import uuid

import pytest
from pyspark.sql import functions as F

from tierlake.operators.conform import SchemaMismatch, conform
from tierlake.operators.quality import quality_report
from tierlake.plans.lakehouse import DataQualityError, Lakehouse
from tierlake.plans.layers import gold_trip_revenue, silver_transform
from tierlake.schemas import RAW_TRIP_SCHEMA
from tierlake.sources.files import read_trip_files
from tierlake.sources.fixtures import as_trips, read_table
from tierlake.streaming.incremental import start_incremental

from conftest import SF_SMALL

NOW = dt.datetime(2024, 1, 1)


def trip(spark, **values):
    one = {"VendorID": 1, "tpep_pickup_datetime": dt.datetime(2024, 1, 5, 8), "tpep_dropoff_datetime": dt.datetime(2024, 1, 5, 9),
           "trip_distance": 2.0, "PULocationID": 1, "DOLocationID": 2, "payment_type": 1, "total_amount": 10.0, **values}
    row = tuple(one.get(f.name) for f in RAW_TRIP_SCHEMA.fields)
    return spark.createDataFrame([row], RAW_TRIP_SCHEMA)


def test_gold_sums_all_stored_rows_of_a_touched_trip(spark, workdir):
    lake = Lakehouse(spark, f"{workdir}/lake")
    twice = trip(spark).union(trip(spark, trip_distance=3.0))
    lake.run_batch(twice, "b1", NOW)
    lake.run_batch(trip(spark), "b2", NOW)
    want = {(r["id"], r["total_revenue"]) for r in gold_trip_revenue(lake.silver.read()).collect()}
    assert {(r["id"], r["total_revenue"]) for r in lake.gold.read().collect()} == want


def test_a_row_without_key_columns_is_blocked_before_bronze(spark, workdir):
    lake = Lakehouse(spark, f"{workdir}/lake")
    empty = trip(spark, **{f.name: None for f in RAW_TRIP_SCHEMA.fields})
    for bad in (empty, trip(spark, total_amount=None), trip(spark, tpep_dropoff_datetime=None)):
        with pytest.raises(DataQualityError):
            lake.run_batch(bad, "b1", NOW)
    assert lake.bronze.read().count() == lake.silver.read().count() == 0
    plan = quality_report(silver_transform(empty), rules=("key_columns_present",))._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan


def test_text_is_not_taken_as_a_number(spark):
    text = trip(spark).withColumn("total_amount", F.lit("12"))
    with pytest.raises(SchemaMismatch):
        conform(text, RAW_TRIP_SCHEMA)


def test_folder_with_drifting_files_keeps_all_values(spark, workdir):
    full = trip(spark).withColumn("passenger_count", F.lit(1).cast(RAW_TRIP_SCHEMA["passenger_count"].dataType))
    full.drop("passenger_count").coalesce(1).write.mode("append").parquet(f"{workdir}/raw")
    full.coalesce(1).write.mode("append").parquet(f"{workdir}/raw")
    got = [r["passenger_count"] for r in read_trip_files(spark, f"{workdir}/raw").collect()]
    assert sorted(got, key=str) == [1, None]


def test_streams_of_two_lakes_and_a_fresh_checkpoint_lose_no_file(spark, workdir):
    landing = f"{workdir}/landing"
    trip(spark).coalesce(1).write.mode("append").parquet(landing)
    lakes = [Lakehouse(spark, f"{workdir}/lake{k}") for k in range(2)]
    for lake in lakes:
        start_incremental(lake, landing, clock=lambda b: NOW).awaitTermination(300)
        assert lake.bronze.read().count() == 1
    other = f"{workdir}/landing2"
    trip(spark, total_amount=11.0).coalesce(1).write.mode("append").parquet(other)
    start_incremental(lakes[0], other, clock=lambda b: NOW, checkpoint=f"{workdir}/ckpt").awaitTermination(300)
    assert lakes[0].bronze.read().count() == 2


def test_table_reads_add_no_exchange(spark):
    plan = as_trips(read_table(spark, SF_SMALL, "lineitem"))._jdf.queryExecution().executedPlan().toString()
    assert "RoundRobin" not in plan


def test_other_rows_under_a_known_id_are_refused(spark, workdir):
    from tierlake.sinks.tables import BatchConflictError
    lake = Lakehouse(spark, f"{workdir}/lake")
    first = trip(spark)
    lake.run_batch(first, "b1", NOW)
    assert lake.row_counts["b1", "bronze"] == 1
    lake.run_batch(first, "b1", dt.datetime(2025, 1, 1))  # a replay, whatever the clock
    more = first.union(first.withColumn("total_amount", F.col("total_amount") + 1))
    null = first.withColumn("trip_distance", F.lit(None).cast("double"))
    for other in (more, null, first.limit(0)):
        with pytest.raises(BatchConflictError):
            lake.run_batch(other, "b1", NOW)
    assert lake.bronze.read().count() == 1 and lake.row_counts["b1", "bronze"] == 1
    again = Lakehouse(spark, f"{workdir}/lake")
    again.run_batch(first, "b1", NOW)
    assert again.row_counts["b1", "bronze"] == again.row_counts["b1", "gold"] == 0
    lake.run_batch(more, "b2", NOW)
    assert lake.bronze.read().count() == 2


def moved(spark):
    """A trip without a dropoff, and one without a pickup, under one id (ids skip NULLs)."""
    x = dt.datetime(2024, 1, 5, 8)
    return (trip(spark, tpep_pickup_datetime=x, tpep_dropoff_datetime=None),
            trip(spark, tpep_pickup_datetime=None, tpep_dropoff_datetime=x, trip_distance=7.0))


def test_a_trip_that_moves_has_one_row_in_silver_and_gold(spark, workdir):
    lake = Lakehouse(spark, f"{workdir}/lake", blocking_rules=(), daily_rollup=True)
    first, second = moved(spark)
    other = trip(spark, tpep_dropoff_datetime=dt.datetime(2024, 1, 5, 11))
    lake.run_batch(first.union(other), "b1", NOW)
    lake.run_batch(second, "b2", dt.datetime(2024, 2, 1))
    lake.run_batch(second, "b2", dt.datetime(2024, 2, 1))
    got = lake.silver.read().where("trip_distance = 7").collect()
    assert len(got) == 1 and lake.silver.read().count() == 2
    assert sorted((r["day"], r["total_revenue"]) for r in lake.gold.read().collect()) == [(5, 10.0), (5, 10.0)]
    assert [(r["day"], r["total_revenue"], r["trip_count"]) for r in lake.gold_daily.read().collect()] == [(5, 20.0, 2)]
    lake.run_batch(first.withColumn("trip_distance", F.lit(8.0)), "b3", NOW)
    assert sorted((r["day"] or 0, r["total_revenue"]) for r in lake.gold.read().collect()) == [(0, 10.0), (5, 10.0)]
    assert sorted((r["day"] or 0, r["total_revenue"], r["trip_count"]) for r in lake.gold_daily.read().collect()) == [(0, 10.0, 1), (5, 10.0, 1)]


def test_layers_follow_the_batches_they_lack(spark, workdir):
    now = dt.datetime(2024, 3, 1)
    lake = Lakehouse(spark, f"{workdir}/lake", blocking_rules=(), daily_rollup=True)
    first, second = moved(spark)
    months = [trip(spark, tpep_pickup_datetime=dt.datetime(2024, m, 5, 8), tpep_dropoff_datetime=dt.datetime(2024, m, 5, 9)) for m in (1, 2, 3)]
    lake.run_batch(first.union(months[0]), "b1", NOW)
    lake.load_bronze(second.union(months[1]), "b2", now)
    lake.load_bronze(months[2].union(months[1].withColumn("trip_distance", F.lit(9.0))), "b3", now)
    assert lake.lacking("silver") == ["b2", "b3"] and lake.lacking("gold") == []
    plan = lake.bronze.extract_batch("b3")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "PartitionFilters: []" not in plan and "EqualTo(batch_id,b3)" in plan
    # Only the two months of the batch are opened.
    read = lake.bronze.in_partitions(lake.bronze.commit_of("b3")["partitions"]).select("pickup_month").distinct().collect()
    assert sorted(r["pickup_month"] for r in read) == ["2024-02", "2024-03"]
    assert lake.silver_from_new_batches(now) == ["b2", "b3"] and lake.silver_from_new_batches(now) == []
    assert lake.gold_from_new_batches(now) == ["b2", "b3"] and lake.lacking("gold") == []
    whole = Lakehouse(spark, f"{workdir}/whole", blocking_rules=(), daily_rollup=True)
    whole.run_batch(first.union(months[0]), "b1", NOW)
    whole.run_batch(second.union(months[1]), "b2", now)
    whole.run_batch(months[2].union(months[1].withColumn("trip_distance", F.lit(9.0))), "b3", now)
    for name in ("silver", "gold"):
        a, b = (sorted(map(tuple, getattr(x, name).read().drop("ingested_date").collect()), key=repr) for x in (lake, whole))
        assert a == b
    days = ["year", "month", "day", "total_revenue", "trip_count"]
    assert sorted(map(tuple, lake.gold_daily.read().select(*days).collect()), key=repr) == \
        sorted(map(tuple, whole.gold_daily.read().select(*days).collect()), key=repr)


def test_the_daily_table_rewrites_only_touched_months(spark, workdir):
    lake = Lakehouse(spark, f"{workdir}/lake", daily_rollup=True)
    jan, feb = (trip(spark, tpep_pickup_datetime=dt.datetime(2024, m, 5, 8), tpep_dropoff_datetime=dt.datetime(2024, m, 5, 9)) for m in (1, 2))
    lake.run_batch(jan.union(feb), "b1", NOW)
    january = sorted(glob.glob(f"{lake.gold_daily.root}/year=2024/month=1/*.parquet"))
    lake.run_batch(feb.withColumn("total_amount", F.lit(3.0)), "b2", NOW)
    assert january and sorted(glob.glob(f"{lake.gold_daily.root}/year=2024/month=1/*.parquet")) == january
    assert sorted((r["month"], r["total_revenue"], r["trip_count"]) for r in lake.gold_daily.read().collect()) == [(1, 10.0, 1), (2, 13.0, 2)]


def test_catalog_tables_are_created_read_by_name_and_dropped(spark, workdir):
    from tierlake.sinks.catalog_tables import append_rows, create_table, drop_table, extract_batch, publish, refresh_partitions

    lake = Lakehouse(spark, f"{workdir}/lake")
    lake.run_batch(trip(spark), "b1", NOW)
    name = f"spark_catalog.default.gold_{uuid.uuid4().hex}"
    publish(lake.gold, name)
    assert spark.read.table(name).count() == 1
    assert [r[0] for r in spark.sql(f"SHOW PARTITIONS {name}").collect()] == ["year=2024/month=1/day=5"]
    lake.run_batch(trip(spark, tpep_dropoff_datetime=dt.datetime(2024, 2, 1, 9)), "b2", NOW)
    refresh_partitions(spark, name)
    assert spark.sql(f"SELECT id FROM {name} WHERE month = 2").count() == 1
    assert extract_batch(spark, name, "b2").count() == 1 and extract_batch(spark, name).count() == 2
    plan = spark.read.table(name).where("month = 2")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in plan
    drop_table(spark, name)
    assert not spark.catalog.tableExists(name) and lake.gold.read().count() == 2
    raw = f"spark_catalog.default.raw_{uuid.uuid4().hex}"
    create_table(spark, raw, RAW_TRIP_SCHEMA, f"{workdir}/raw")
    append_rows(trip(spark).select(*reversed(RAW_TRIP_SCHEMA.fieldNames())), raw)
    assert spark.read.table(raw).collect() == trip(spark).collect()
    create_table(spark, raw, RAW_TRIP_SCHEMA, f"{workdir}/raw2")   # dropped and created anew
    assert spark.read.table(raw).count() == 0
    drop_table(spark, raw)
