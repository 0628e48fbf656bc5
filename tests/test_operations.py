"""Operations-log table, download planning, session settings, DDL text,
quality gate and SQL views over the layers."""

import datetime as dt
import os

import pytest

from tierlake.operators.manifest import plan_downloads
from tierlake.plans.lakehouse import DataQualityError, Lakehouse, stage
from tierlake.plans.operations_log import OperationsLog
from tierlake.schemas import GOLD_SCHEMA, OPLOG_SCHEMA, ddl
from tierlake.session import catalog_conf, object_store_conf
from tierlake.sources.listing import list_files


def d(day):
    return dt.datetime(2024, 1, day)


def test_operations_log_table(spark, workdir):
    log = OperationsLog(spark, f"{workdir}/log")
    assert log.read().count() == 0 and log.retry_candidates().count() == 0
    log.log_status("a.parquet", "u/a", "failed", d(1), "timeout")
    log.log_status("a.parquet", "u/a", "failed", d(2), "again")   # a later attempt
    log.log_status("b.parquet", "u/b", "failed", d(1), "it's broken")
    assert log.read().count() == 3
    assert log.failed_count("a.parquet") == 2
    log.record([("b.parquet", "u/b", "failed", d(3), "x"), ("c.parquet", "u/c", "ok", d(3), "")])
    assert log.read().count() == 4    # b was known: not inserted
    log.deduplicate()
    assert {r.fileName for r in log.retry_candidates().collect()} == {"a.parquet", "b.parquet"}
    log.log_status("a.parquet", "u/a", "done", d(4))    # clears the failure
    assert {r.fileName for r in log.retry_candidates().collect()} == {"b.parquet"}
    # One appended file holds the last attempt; the compacted rows are as they were.
    assert len(log._generations()) == 1 and log.files() >= 2


def test_attempts_are_appended_and_compacted(spark, workdir):
    log = OperationsLog(spark, f"{workdir}/log", compact_above=3)
    folder = log._folder(0)
    for n in range(1, 5):
        before = set(os.listdir(folder)) if n > 1 else set()
        log.log_status(f"f{n % 2}", "u", "failed" if n < 4 else "done", d(n))
        assert len({f for f in set(os.listdir(folder)) - before if f.endswith(".parquet")}) == 1
    # A compaction that was stopped has no success marker and is not read.
    os.makedirs(log._folder(1))
    assert log.files() == 4 and log.read().count() == 4
    log.log_status("f2", "u", "failed", d(9))
    assert log._generations() == [1] and log.files() < 4 and log.read().count() == 5
    assert {r.fileName for r in log.retry_candidates().collect()} == {"f1", "f2"}
    assert log.failed_count("f1") == 2
    plan = log.read().where("fileName = 'f1' AND status = 'failed'")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(fileName,f1)" in plan and "EqualTo(status,failed)" in plan


def test_plan_downloads_from_listing(spark, workdir):
    for m in (1, 2, 3):
        spark.createDataFrame([(1,)], "x int").coalesce(1).write.parquet(
            f"{workdir}/parquetfiles/2012/yellow_tripdata_2012-{m:02d}.parquet")
    # Listed names are the part files inside each written folder; list the
    # folders' parent and take the folder name as the stored file.
    listing = list_files(spark, f"{workdir}/parquetfiles")
    folders = listing.selectExpr(
        "regexp_extract(path, '(.*/yellow_tripdata_[0-9-]+\\\\.parquet)/', 1) AS path", "length")
    log = spark.createDataFrame([("yellow_tripdata_2012-02.parquet", "", "failed", d(1), "")],
                                OPLOG_SCHEMA)
    plan = {(r.file_name, r.reason) for r in
            plan_downloads(spark, folders, log, 2012, 2012).collect()}
    assert len(plan) == 10
    assert ("yellow_tripdata_2012-02.parquet", "retry") in plan
    assert ("yellow_tripdata_2012-04.parquet", "missing") in plan


def test_object_store_conf_and_ddl():
    conf = object_store_conf("http://store:9000", "key", "secret")
    assert conf["spark.hadoop.fs.s3a.endpoint"] == "http://store:9000"
    assert conf["spark.hadoop.fs.s3a.path.style.access"] == "true"
    text = ddl(GOLD_SCHEMA, "trip_info_g", "s3a://lake/gold/", ["year", "month", "day"])
    assert "`total_revenue` double" in text and "PARTITIONED BY (year, month, day)" in text


def test_catalog_settings():
    conf = catalog_conf("lake", "org.example.Catalog", type="hive", uri="thrift://host:9083")
    assert conf == {"spark.sql.catalog.lake": "org.example.Catalog", "spark.sql.catalog.lake.type": "hive",
                    "spark.sql.catalog.lake.uri": "thrift://host:9083"}


def test_stage_counts_rows_while_writing(spark):
    df, n = stage(spark.range(1234), "count-test")
    assert n == 1234 and df.count() == 1234


def test_quality_gate_and_views(spark, workdir):
    lake = Lakehouse(spark, f"{workdir}/lake", blocking_rules=("payment_type_known",))
    bad = spark.createDataFrame(
        [(1, d(1), d(1), 1.0, 1, 1, 9, 10.0)],
        "VendorID long, tpep_pickup_datetime timestamp_ntz, "
        "tpep_dropoff_datetime timestamp_ntz, trip_distance double, PULocationID int, "
        "DOLocationID int, payment_type int, total_amount double")
    with pytest.raises(DataQualityError):
        lake.run_batch(bad, "bad", d(2))
    assert spark.read.parquet(lake.replay_log).first().batch_id == "bad"
    ok = Lakehouse(spark, f"{workdir}/ok")
    ok.run_batch(bad, "b1", d(2))
    ok.register_views()
    got = spark.sql("SELECT id, total_revenue FROM trip_info_g WHERE year = 2024").collect()
    assert len(got) == 1 and got[0].total_revenue == 10.0
    assert spark.sql("SELECT count(*) AS n FROM trip_info_s").first().n == 1


def test_session_bootstrap_and_shared_dir(spark):
    from tierlake.session import build_session, shared_dir
    s = build_session("again", catalog="spark_catalog", database="default")
    assert s is spark or s.sparkContext is spark.sparkContext
    assert s.catalog.currentCatalog() == "spark_catalog"
    assert s.catalog.currentDatabase() == "default"
    base = spark.conf.get("spark.checkpoint.dir")
    assert shared_dir(spark, "x", "y") == base.rstrip("/") + "/x/y"
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
