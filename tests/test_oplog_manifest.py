"""Operations log statements and the file manifest."""

import datetime as dt

from tierlake.operators import oplog
from tierlake.operators.latest import keep_latest
from tierlake.operators.manifest import (
    completeness,
    download_plan,
    expected_files,
    missing_files,
    year_range,
)
from tierlake.schemas import OPLOG_SCHEMA


def d(day):
    return None if day is None else dt.datetime(2024, 1, day)


def test_keep_latest_fixture(spark):
    data = [("f1", d(1), 1), ("f1", d(2), 2), ("f1", d(2), 3), ("f2", None, 4),
            ("f2", d(1), 5), (None, d(5), 6), ("f3", None, 7)]
    df = spark.createDataFrame(data, "filename string, updated_date timestamp_ntz, n int")
    assert sorted(r.n for r in keep_latest(df, "filename", "updated_date").collect()) == \
        [2, 3, 5, 6, 7]


def log_rows(spark, rows):
    return spark.createDataFrame(rows, OPLOG_SCHEMA)


def test_insert_if_absent_and_counts(spark):
    log = log_rows(spark, [("a.parquet", "u/a", "failed", d(1), "e1"),
                           ("a.parquet", "u/a", "failed", d(2), "e2"),
                           ("b.parquet", "u/b", "ok", d(1), "")])
    new = log_rows(spark, [("a.parquet", "u/a", "failed", d(3), "e3"),
                           ("c.parquet", "u/c", "failed", d(3), "e"),
                           (None, "u/?", "failed", d(3), "e")])
    ins = oplog.insert_if_absent(log, new).collect()
    assert sorted(str(r.fileName) for r in ins) == ["None", "c.parquet"]
    assert oplog.append_if_absent(log, new).count() == 5
    assert oplog.failed_count(log, "a.parquet").first().failed_count == 2
    assert oplog.failed_count(log, "zzz").first().failed_count == 0
    latest = {r.fileName: r.updated_date for r in oplog.latest_update(log).collect()}
    assert latest == {"a.parquet": d(2), "b.parquet": d(1)}


def test_retry_candidates_use_latest_status(spark):
    log = log_rows(spark, [("a", "u", "failed", d(1), ""), ("a", "u", "done", d(2), ""),
                           ("b", "u", "done", d(1), ""), ("b", "u", "failed", d(2), "")])
    assert [r.fileName for r in oplog.retry_candidates(log).collect()] == ["b"]


def test_expected_missing_and_plan(spark):
    exp = expected_files(year_range(spark, 2012, 2014))
    names = sorted(r.file_name for r in exp.collect())
    assert len(names) == 36
    assert names[0] == "yellow_tripdata_2012-01.parquet"
    assert names[-1] == "yellow_tripdata_2014-12.parquet"
    r = exp.where("year = 2013 AND month = 7").first()
    assert r.folder == "parquetfiles/2013" and r.url.endswith("/yellow_tripdata_2013-07.parquet")
    present = spark.createDataFrame([(n,) for n in names[:30]], "file_name string")
    assert missing_files(exp, present).count() == 6
    log = log_rows(spark, [(names[0], "", "failed", d(1), "boom"),
                           (names[1], "", "failed", d(1), ""),
                           (names[1], "", "done", d(2), "")])
    plan = {(r.file_name, r.reason) for r in download_plan(exp, present, log).collect()}
    assert (names[0], "retry") in plan and (names[1], "retry") not in plan
    assert sum(1 for _, why in plan if why == "missing") == 6


def test_completeness(spark):
    declared = spark.createDataFrame(
        [("a.parquet", 100), ("b.parquet", None), ("c.parquet", 50), ("d.parquet", 7)],
        "file_name string, declared_length long")
    listing = spark.createDataFrame(
        [("s3a://lake/parquetfiles/2012/a.parquet", 100, d(1)),
         ("s3a://lake/parquetfiles/2012/b.parquet", 9, d(1)),
         ("s3a://lake/parquetfiles/2012/c.parquet", 49, d(1))],
        "path string, length long, modificationTime timestamp")
    got = {r.file_name: r.complete for r in completeness(declared, listing).collect()}
    assert got == {"a.parquet": True, "b.parquet": True, "c.parquet": False,
                   "d.parquet": False}
