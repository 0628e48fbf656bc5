"""Drift-tolerant file scans, lineage, listings."""

import datetime as dt
import os

import pytest

from tierlake.operators.conform import SchemaMismatch
from tierlake.sources import files
from tierlake.sources.files import group_by_physical_schema, read_trip_files
from tierlake.sources.listing import files_of_year, list_files, year_folders


def write(spark, path, rows, ddl):
    spark.createDataFrame(rows, ddl).coalesce(1).write.parquet(path)


def test_schema_drift_widens_and_drops_fee(spark, workdir):
    a, b = f"{workdir}/a", f"{workdir}/b"
    write(spark, a, [(1, 10.0), (2, 20.0)], "VendorID int, total_amount double")
    write(spark, b, [(3_000_000_000, 30.0, 1.25)],
          "VendorID long, total_amount double, airport_fee double")
    df = read_trip_files(spark, [a, b], lineage_col="src", required=[])
    assert dict(df.dtypes)["VendorID"] == "bigint"
    assert "airport_fee" not in [c.lower() for c in df.columns]
    got = sorted((r.VendorID, r.total_amount) for r in df.collect())
    assert got == [(1, 10.0), (2, 20.0), (3_000_000_000, 30.0)]
    assert df.select("src").distinct().count() == 2
    assert df.where("passenger_count IS NOT NULL").count() == 0


def test_fee_column_case_insensitive(spark, workdir):
    p = f"{workdir}/c"
    write(spark, p, [(1, 5.0, 1.0)], "VendorID int, total_amount double, Airport_fee double")
    df = read_trip_files(spark, [p], required=[])
    assert not [c for c in df.columns if c.lower() == "airport_fee"]
    assert df.count() == 1


def test_narrowing_is_checked(spark, workdir):
    ok, bad = f"{workdir}/ok", f"{workdir}/bad"
    write(spark, ok, [(1, 2.0)], "VendorID long, passenger_count double")
    write(spark, bad, [(1, 3e10)], "VendorID long, passenger_count double")
    assert read_trip_files(spark, [ok], required=[]).first().passenger_count == 2
    with pytest.raises(Exception, match="out of range|OVERFLOW"):
        read_trip_files(spark, [bad], required=[]).collect()


def test_files_without_a_key_column_are_refused_and_extra_columns_named(spark, workdir, caplog):
    whole = "VendorID long, tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz, total_amount double"
    t = dt.datetime(2024, 1, 1)
    write(spark, f"{workdir}/raw/a", [(1, t, t, 2.0)], whole)
    write(spark, f"{workdir}/raw/b", [(1, t, t, 2.0, "x")], whole + ", cbd_fee string")
    with caplog.at_level("WARNING"):
        assert read_trip_files(spark, f"{workdir}/raw").count() == 2
    assert "columns not loaded: ['cbd_fee']" in caplog.text
    write(spark, f"{workdir}/raw/c", [(1, t, t)], whole.replace(", total_amount double", ""))
    with pytest.raises(SchemaMismatch, match="total_amount"):
        read_trip_files(spark, f"{workdir}/raw")


def test_footers_are_read_in_tasks(spark, workdir):
    """The number of jobs does not grow with the files, and tasks see the schemas that Spark sees."""
    def jobs(tag, action):
        spark.sparkContext.setJobGroup(tag, tag)
        out = action()
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return out, len(spark.sparkContext.statusTracker().getJobIdsForGroup(tag))

    for n in (4, 40):
        for k in range(2):
            (spark.range(0, 10 * n, 1, n // 2).selectExpr("id AS VendorID" if k else "CAST(id AS INT) AS VendorID", "TIMESTAMP_NTZ'2024-01-01' AS tpep_pickup_datetime",
                                       "TIMESTAMP'2024-01-01' AS zoned", "CAST(1.5 AS DECIMAL(9, 2)) AS total_amount", "array(id) AS a")
             .write.parquet(f"{workdir}/{n}/{k}"))
    counts = []
    for n in (4, 40):
        groups, many = jobs(f"footers-{n}", lambda n=n: group_by_physical_schema(spark, f"{workdir}/{n}"))
        counts.append(many)
        assert sorted(len(g.paths) for g in groups) == [n // 2, n // 2]
        for g in groups:
            assert [(f.name, f.dataType.simpleString()) for f in g.schema] == [(f.name, f.dataType.simpleString()) for f in spark.read.parquet(g.paths[0]).schema]
    assert counts[0] == counts[1]
    # Files that Spark did not write: from the footer's own types.
    import pyarrow as pa
    import pyarrow.parquet as pq
    os.makedirs(f"{workdir}/other")
    stamp = [dt.datetime(2024, 1, 1)]
    mixed = pa.table({"VendorID": pa.array([1], pa.int32()), "local": pa.array(stamp, pa.timestamp("us")), "day": pa.array([stamp[0].date()]),
                      "instant": pa.array(stamp, pa.timestamp("us", tz="UTC")), "flag": ["N"], "d": pa.array([1.5], pa.float32())})
    pq.write_table(mixed, f"{workdir}/other/a.parquet")
    pq.write_table(pa.table({"old": pa.array(stamp, pa.timestamp("ns"))}), f"{workdir}/other/b.parquet", use_deprecated_int96_timestamps=True)
    for g in group_by_physical_schema(spark, f"{workdir}/other"):
        assert [(f.name, f.dataType.simpleString()) for f in g.schema] == [(f.name, f.dataType.simpleString()) for f in spark.read.parquet(g.paths[0]).schema]
    # Files that are all alike are read by their folder; no path is brought in.
    assert [g.paths for g in group_by_physical_schema(spark, f"{workdir}/40/0")] == [(f"{workdir}/40/0",)]
    assert [type(g.schema["zoned"].dataType).__name__ for g in groups] == ["TimestampType"] * 2


def test_other_schemes_go_through_sparks_reader(spark, workdir, monkeypatch):
    monkeypatch.setattr(files, "TASK_SCHEMES", {})
    write(spark, f"{workdir}/raw/a", [(1,)], "VendorID int")
    write(spark, f"{workdir}/raw/b", [(1,)], "VendorID long")
    assert sorted(g.schema["VendorID"].dataType.simpleString() for g in group_by_physical_schema(spark, f"{workdir}/raw")) == ["bigint", "int"]


def test_listing_by_year(spark, workdir):
    for y, m in [(2012, 1), (2012, 2), (2013, 5)]:
        write(spark, f"{workdir}/parquetfiles/{y}/yellow_tripdata_{y}-{m:02d}.parquet",
              [(1,)], "x int")
    listing = list_files(spark, f"{workdir}/parquetfiles")
    assert set(listing.columns) == {"path", "length", "modificationTime"}
    assert {r.year for r in year_folders(listing).collect()} == {2012, 2013}
    paths = [r.path for r in files_of_year(listing, 2012).collect()]
    assert paths and all("/parquetfiles/2012/" in p for p in paths)
    assert all(r.length == os.path.getsize(r.path.replace("file:", ""))
               for r in listing.collect())
