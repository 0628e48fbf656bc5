"""Partitioned tables, the replay log, the batch lakehouse run."""

import datetime as dt
import glob
import os

import pytest
from pyspark.sql import functions as F

from tierlake.operators.merge import merge_upsert
from tierlake.plans.lakehouse import Lakehouse
from tierlake.schemas import GOLD_PARTITIONS, GOLD_SCHEMA, REPLAY_LOG_SCHEMA, SILVER_SCHEMA
from tierlake.sinks import tables as sink
from tierlake.sinks.tables import BatchConflictError, PartitionedTable, failures_recorded
from tierlake.plans.layers import silver_transform
from tierlake.sources.fixtures import as_trips, read_table

from conftest import SF_SMALL

T1, T2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1)
AUDIT = ["batch_id", "updated_date", "ingested_date"]


def kv_schema():
    from pyspark.sql.types import LongType, StringType, StructField, StructType
    return StructType([StructField("id", LongType()), StructField("v", StringType())])


def rows(df, cols=None):
    return sorted((tuple(r) for r in (df.select(*cols) if cols else df).collect()), key=repr)


def test_batches_with_alike_ids_are_kept_apart(spark, workdir):
    table = PartitionedTable(spark, f"{workdir}/tbl", GOLD_SCHEMA, GOLD_PARTITIONS)
    for n, batch in enumerate(["a/b", "a_b", "a b", "a_2f_b", "..", "a:b"]):
        merged = table.merge(gold_rows(spark, [(f"t{n}", 2024, 1, n + 1, 1.0)], batch, T1), ["id"], batch)
        assert merged is not None and table.has_batch(batch)
        assert table.read().count() == n + 1


def gold_rows(spark, data, batch, ts):
    return spark.createDataFrame([(i, y, m, d, r, batch, ts, ts) for i, y, m, d, r in data],
                                 GOLD_SCHEMA)


def test_partitioned_merge_rewrites_touched_partitions_only(spark, workdir):
    root = f"{workdir}/gold"
    g = PartitionedTable(spark, root, GOLD_SCHEMA, GOLD_PARTITIONS)
    first = gold_rows(spark, [("a", 2024, 1, 1, 1.0), ("b", 2024, 1, 2, 2.0),
                              ("c", 2024, 1, 3, 3.0)], "b1", T1)
    g.merge(first, ["id"], "b1")
    day1 = sorted(glob.glob(f"{root}/year=2024/month=1/day=1/*.parquet"))
    day3 = sorted(glob.glob(f"{root}/year=2024/month=1/day=3/*.parquet"))
    second = gold_rows(spark, [("b", 2024, 1, 2, 20.0), ("d", 2024, 1, 2, 4.0)], "b2", T2)
    scoped = g.scope(second)
    assert "PartitionFilters" in scoped._jdf.queryExecution().executedPlan().toString()
    assert scoped.count() == 1
    g.merge(second, ["id"], "b2")
    # Untouched partitions keep their files; the touched one is rewritten.
    assert sorted(glob.glob(f"{root}/year=2024/month=1/day=1/*.parquet")) == day1
    assert sorted(glob.glob(f"{root}/year=2024/month=1/day=3/*.parquet")) == day3
    expected = merge_upsert(first, second, ["id"], preserve=["ingested_date"])
    assert rows(g.read(), GOLD_SCHEMA.fieldNames()) == rows(expected)
    b = g.read().where("id = 'b'").first()
    assert (b.total_revenue, b.batch_id, b.ingested_date) == (20.0, "b2", T1)


def test_failures_are_recorded_and_reraised(spark, workdir):
    log = f"{workdir}/replay"
    with pytest.raises(ZeroDivisionError):
        with failures_recorded(spark, log, "batch-7"):
            1 / 0
    got = spark.read.schema(REPLAY_LOG_SCHEMA).parquet(log).collect()
    assert [(r.batch_id, r.error.split(":")[0]) for r in got] == [("batch-7", "ZeroDivisionError")]


def write_trip_files(spark, workdir):
    """Two monthly 'files' from lineitem with drifting VendorID width and fee column."""
    trips = as_trips(read_table(spark, SF_SMALL, "lineitem"))
    f1, f2 = f"{workdir}/landing/f1", f"{workdir}/landing/f2"
    (trips.where("payment_type <= 5").withColumn("VendorID", F.col("VendorID").cast("int"))
     .drop("airport_fee").coalesce(1).write.parquet(f1))
    (trips.where("payment_type >= 4").withColumn("trip_distance", F.col("trip_distance") * 2)
     .coalesce(1).write.parquet(f2))
    return f1, f2, trips


def test_lakehouse_incremental_equals_single_batch(spark, workdir):
    f1, f2, trips = write_trip_files(spark, workdir)
    inc = Lakehouse(spark, f"{workdir}/inc")
    inc.run_files([f1], "b1", T1)
    inc.run_files([f2], "b2", T2)
    one = Lakehouse(spark, f"{workdir}/one")
    both = spark.read.parquet(f2).unionByName(
        spark.read.parquet(f1).where("payment_type < 4"), allowMissingColumns=True)
    one.run_batch(both, "all", T2)
    cols = [c for c in SILVER_SCHEMA.fieldNames() if c not in AUDIT]
    assert inc.silver.read().count() == trips.count()
    assert rows(inc.silver.read(), cols) == rows(one.silver.read(), cols)
    gcols = [c for c in GOLD_SCHEMA.fieldNames() if c not in AUDIT]
    assert rows(inc.gold.read(), gcols) == rows(one.gold.read(), gcols)
    # Matched keys keep the first ingestion time and carry the new batch id.
    s = inc.silver.read()
    assert s.where("batch_id = 'b2' AND ingested_date = TIMESTAMP_NTZ'2024-01-01'").count() == \
        trips.where("payment_type IN (4, 5)").count()
    assert "airport_fee" not in [c.lower() for c in inc.bronze.read().columns]


def test_layout_partitions_and_replay(spark, workdir):
    from pyspark.sql.types import StructField, StructType, TimestampNTZType
    schema = StructType([StructField("ts", TimestampNTZType()), *kv_schema().fields])
    root = f"{workdir}/bronze"
    t = PartitionedTable(spark, root, schema, ["m"], {"m": "date_format(ts, 'yyyy-MM')"},
                         local_check="ts IS NOT NULL")
    jan, feb = dt.datetime(2024, 1, 5), dt.datetime(2024, 2, 5)
    t.merge(spark.createDataFrame([(jan, 1, "a"), (feb, 2, "b")], schema), ["ts", "id"], "b1",
            preserve=[])
    jan_files = sorted(glob.glob(f"{root}/m=2024-01/*.parquet"))
    second = spark.createDataFrame([(feb, 2, "B"), (feb, 3, "c")], schema)
    assert "PartitionFilters: [isnotnull(m" in \
        t.scope(second)._jdf.queryExecution().executedPlan().toString() or \
        t.scope(second).count() == 1
    assert t.merge(second, ["ts", "id"], "b2", preserve=[]) is not None
    assert sorted(glob.glob(f"{root}/m=2024-01/*.parquet")) == jan_files
    assert rows(t.read()) == [(jan, 1, "a"), (feb, 2, "B"), (feb, 3, "c")]
    assert t.read().columns == schema.fieldNames()
    # Replaying a committed batch changes nothing.
    assert t.merge(second, ["ts", "id"], "b2", preserve=[]) is None
    assert t.read().count() == 3
    # Without an entry in the side table nothing else is read for a key that may lie elsewhere.
    odd = spark.createDataFrame([(None, 9, "z")], schema)
    assert t.scope(odd, ["ts", "id"]).count() == 0


def moving_table(spark, workdir, **options):
    """Rows (id, place, v): an id may change its place only while ``v`` is NULL."""
    schema = "id long, place string, v string, batch_id string, updated_date timestamp_ntz, ingested_date timestamp_ntz"
    return PartitionedTable(spark, f"{workdir}/t", spark.createDataFrame([], schema).schema, ["place"],
                            local_check="v IS NOT NULL", **options)


def moving_rows(table, data, batch, ts):
    return table.spark.createDataFrame([(*r, batch, ts, ts) for r in data], table.schema)


def places(table):
    return sorted(n for n in os.listdir(table.root) if n.startswith("place="))


def test_moved_keys_leave_their_partition(spark, workdir):
    t = moving_table(spark, workdir)
    t.merge(moving_rows(t, [(1, "a", None), (2, "a2", None), (3, "b", "x"), (4, "c", "x"), (5, "a2", "y")], "b1", T1), ["id"], "b1")
    files = {p: sorted(glob.glob(f"{t.root}/place={p}/*.parquet")) for p in "bc"}
    second = moving_rows(t, [(1, "z", None), (2, "c", None), (9, None, "n")], "b2", T2)
    # Only the places of the moved keys are read, and the table is not searched for them.
    assert sorted({r.place for r in t.scope(second, ["id"]).collect()}) == ["a", "a2", "c"]
    t.merge(second, ["id"], "b2")
    assert sorted((r.id, r.place, r.batch_id, r.ingested_date) for r in t.read().collect()) == [
        (1, "z", "b2", T1), (2, "c", "b2", T1), (3, "b", "b1", T1), (4, "c", "b1", T1), (5, "a2", "b1", T1), (9, None, "b2", T2)]
    # The emptied partition's files are gone; an untouched one keeps its files.
    assert glob.glob(f"{t.root}/place=a/*.parquet") == []
    assert sorted(glob.glob(f"{t.root}/place=b/*.parquet")) == files["b"]
    assert sorted(glob.glob(f"{t.root}/place=c/*.parquet")) != files["c"]
    # And back again: a place that was emptied is found through the same side table.
    t.merge(moving_rows(t, [(1, "a", None)], "b3", T2), ["id"], "b3")
    assert sorted((r.id, r.place) for r in t.read().where("id = 1").collect()) == [(1, "a")]


class Stop(Exception):
    pass


@pytest.mark.parametrize("at, other_first", [("intent", False), ("half_swap", False), ("half_swap", True), ("clear", True),
                                             ("done", False), ("forget", False)])
def test_a_batch_stopped_anywhere_is_applied_once(spark, workdir, monkeypatch, at, other_first):
    first = [(1, "z", None), (None, "a", "n"), (7, "d", "dup"), (7, "d", "dup")]
    second = [(1, "b", None), (None, "a", "n"), (None, "a", "n"), (8, "e", "dup"), (8, "e", "dup")]
    want = moving_table(spark, f"{workdir}/want")
    t = moving_table(spark, f"{workdir}/got")
    for table in (want, t):
        table.merge(moving_rows(table, first, "b1", T1), ["id"], "b1")
    want.merge(moving_rows(want, second, "b2", T2), ["id"], "b2")

    real = {n: getattr(sink._FS, n) for n in ("write_json", "delete")}
    write = PartitionedTable._write

    def stop_json(fs, path, value):
        if at == "intent" and "/_pending/" in path or at == "done" and "/_batches/" in path:
            raise Stop
        real["write_json"](fs, path, value)

    def stop_delete(fs, path):
        if at == "clear" and "/place=" in path or at == "forget" and "/_pending/" in path:
            raise Stop
        real["delete"](fs, path)

    def stop_write(table, staged, keys, n):
        if at == "half_swap":
            part = table._with_layout(spark.read.schema(table.schema).parquet(staged)).where("place = 'a'")
            part.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("place").parquet(table.root)
            raise Stop
        write(table, staged, keys, n)

    with monkeypatch.context() as patched:
        patched.setattr(sink._FS, "write_json", stop_json)
        patched.setattr(sink._FS, "delete", stop_delete)
        patched.setattr(PartitionedTable, "_write", stop_write)
        with pytest.raises(Stop):
            t.merge(moving_rows(t, second, "b2", T2), ["id"], "b2")
    t = moving_table(spark, f"{workdir}/got")
    if other_first:
        for table in (want, t):
            table.merge(moving_rows(table, [(1, "c", None), (99, "a", "x")], "b3", T2), ["id"], "b3")
    t.merge(moving_rows(t, second, "b2", T2), ["id"], "b2")
    assert rows(t.read()) == rows(want.read())
    assert t.batches() == want.batches()
    with pytest.raises(BatchConflictError):
        t.merge(moving_rows(t, second[:1], "b2", T2), ["id"], "b2")


def test_a_first_load_stopped_half_way_is_completed(spark, workdir, monkeypatch):
    t = moving_table(spark, workdir)
    first = moving_rows(t, [(1, "a", "x"), (None, "a", "n"), (2, "b", "x")], "b1", T1)
    write = PartitionedTable._write

    def half(table, staged, keys, n):
        part = table._with_layout(spark.read.schema(table.schema).parquet(staged)).where("place = 'a'")
        part.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("place").parquet(table.root)
        raise Stop

    monkeypatch.setattr(PartitionedTable, "_write", half)
    with pytest.raises(Stop):
        t.merge(first, ["id"], "b1")
    monkeypatch.setattr(PartitionedTable, "_write", write)
    t.merge(first, ["id"], "b1")
    assert t.read().count() == 3 and t.batches() == ["b1"]


def test_files_follow_the_bytes(spark, workdir):
    one = spark.range(20_000).selectExpr("id", "'m' AS place", "sha2(string(id), 256) AS v")
    t = moving_table(spark, f"{workdir}/small")
    t.merge(one.selectExpr("*", "'b1' AS batch_id", "TIMESTAMP_NTZ'2024-01-01' AS updated_date", "TIMESTAMP_NTZ'2024-01-01' AS ingested_date"),
            ["id"], "b1")
    assert len(glob.glob(f"{t.root}/place=m/*.parquet")) == 1
    # Rows of one key, NULL here, are split as well.
    size = sum(os.path.getsize(f) for f in glob.glob(f"{t.root}/place=m/*.parquet"))
    t = moving_table(spark, f"{workdir}/large", target_file_bytes=size // 9)
    t.merge(one.selectExpr("CAST(NULL AS BIGINT) AS id", "place", "v", "'b1' AS batch_id", "TIMESTAMP_NTZ'2024-01-01' AS updated_date",
                           "TIMESTAMP_NTZ'2024-01-01' AS ingested_date"), ["id"], "b1")
    files = glob.glob(f"{t.root}/place=m/*.parquet")
    assert 8 <= len(files) <= 12 and t.read().count() == 20_000
    counts = [spark.read.parquet(f).count() for f in files]
    assert max(counts) < 2 * min(counts)


def test_daily_rollup_follows_touched_days(spark, workdir):
    from tierlake.plans.layers import gold_daily_revenue
    f1, f2, trips = write_trip_files(spark, workdir)
    lake = Lakehouse(spark, f"{workdir}/lake", daily_rollup=True)
    lake.run_files([f1], "b1", T1)
    lake.run_files([f2], "b2", T2)
    expected = gold_daily_revenue(silver_transform(trips.drop("airport_fee")))
    cols = ["year", "month", "day", "total_revenue", "trip_count"]
    assert rows(lake.gold_daily.read(), cols) == rows(expected, cols)
    # Days touched by both batches carry the second batch id, first ingestion time.
    d = lake.gold_daily.read()
    assert d.where("batch_id = 'b2' AND ingested_date = TIMESTAMP_NTZ'2024-01-01'").count() > 0


def test_staged_copies_are_removed_after_success(spark, workdir, monkeypatch):
    import tierlake.plans.lakehouse as lh
    deleted = []
    real_delete = lh.delete_path

    def recording_delete(spark_, path):
        deleted.append(path)
        real_delete(spark_, path)

    monkeypatch.setattr(lh, "delete_path", recording_delete)
    lake = Lakehouse(spark, f"{workdir}/lake")
    trips = as_trips(read_table(spark, SF_SMALL, "lineitem")).limit(50)
    lake.run_batch(trips, "b1", T1)
    assert lake._staged == [] and len(deleted) == 3
    assert not any(os.path.exists(p.replace("file:", "")) for p in deleted)
    assert lake.silver.read().count() == 50


def test_a_stopped_batch_leaves_no_trace_and_may_come_again(spark, workdir):
    from tierlake.plans.lakehouse import DataQualityError
    trips = as_trips(read_table(spark, SF_SMALL, "lineitem")).limit(60)
    lake = Lakehouse(spark, f"{workdir}/lake", blocking_rules=("payment_type_known",))
    with pytest.raises(DataQualityError):          # lineitem has payment type 7
        lake.run_batch(trips, "b1", T1)
    for layer in ("bronze", "silver", "gold"):
        assert not getattr(lake, layer).has_batch("b1") and getattr(lake, layer).read().count() == 0
    mended = trips.withColumn("payment_type", F.least("payment_type", F.lit(6)))
    lake.run_batch(mended, "b1", T1)               # corrected rows under the same id
    clean = Lakehouse(spark, f"{workdir}/clean", blocking_rules=())
    clean.run_batch(mended, "b1", T1)
    for layer in ("bronze", "silver", "gold"):
        assert rows(getattr(lake, layer).read()) == rows(getattr(clean, layer).read()), layer


@pytest.mark.parametrize("layer", ["bronze", "silver", "gold"])
def test_retry_after_partial_failure_equals_clean_run(spark, workdir, monkeypatch, layer):
    trips = as_trips(read_table(spark, SF_SMALL, "lineitem")).limit(30)
    trips = trips.union(trips.limit(1)).withColumn(
        "tpep_pickup_datetime", F.when(F.col("payment_type") > 1, F.col("tpep_pickup_datetime")))   # NULL and repeated keys
    real = sink._FS.write_json

    def stop(fs, path, value):
        if f"/{layer}/_batches/" in path:
            raise Stop
        real(fs, path, value)

    lake = Lakehouse(spark, f"{workdir}/lake", blocking_rules=())
    with monkeypatch.context() as patched:
        patched.setattr(sink._FS, "write_json", stop)
        with pytest.raises(Stop):
            lake.run_batch(trips, "b1", T1)
    lake.run_batch(trips, "b1", T1)                # the retry of the same batch
    clean = Lakehouse(spark, f"{workdir}/clean", blocking_rules=())
    clean.run_batch(trips, "b1", T1)
    for name in ("bronze", "silver", "gold"):
        assert rows(getattr(lake, name).read()) == rows(getattr(clean, name).read()), name


def test_partition_values_with_quotes_and_backslashes(spark, workdir):
    from pyspark.sql.types import StringType, StructField, StructType
    schema = StructType([StructField("zone", StringType()), *kv_schema().fields])
    t = PartitionedTable(spark, f"{workdir}/t", schema, ["zone"])
    t.merge(spark.createDataFrame([("O'Hare", 1, "a"), ("C:\\dir", 2, "b"), ("plain", 3, "c")],
                                  schema), ["id"], "b1", preserve=[])
    second = spark.createDataFrame([("O'Hare", 1, "A"), ("C:\\dir", 4, "d")], schema)
    assert t.scope(second).count() == 2
    t.merge(second, ["id"], "b2", preserve=[])
    assert rows(t.read()) == sorted([("O'Hare", 1, "A"), ("C:\\dir", 2, "b"),
                                     ("plain", 3, "c"), ("C:\\dir", 4, "d")], key=repr)
