"""Structured Streaming runs pick up only new files and equal one batch run."""

import datetime as dt

from tierlake.plans.lakehouse import Lakehouse
from tierlake.schemas import SILVER_SCHEMA
from tierlake.streaming.incremental import start_incremental
from tierlake.sources.fixtures import as_trips, read_table

from conftest import SF_SMALL

AUDIT = ["batch_id", "updated_date", "ingested_date"]


def clock(batch_id):
    return dt.datetime(2024, 3, 1) + dt.timedelta(days=int(batch_id.rsplit("-", 1)[1]))


def rows(df, cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)


def test_two_available_now_runs_equal_one_batch(spark, workdir):
    trips = as_trips(read_table(spark, SF_SMALL, "lineitem"))
    landing = f"{workdir}/landing"
    lake = Lakehouse(spark, f"{workdir}/lake")
    ckpt = f"{workdir}/ckpt"

    trips.where("payment_type <= 3").coalesce(1).write.parquet(f"{landing}/2024-01")
    start_incremental(lake, landing, clock=clock, checkpoint=ckpt).awaitTermination(300)
    first = lake.bronze.read().count()
    assert first == trips.where("payment_type <= 3").count()

    trips.where("payment_type > 3").coalesce(1).write.parquet(f"{landing}/2024-02")
    start_incremental(lake, landing, clock=clock, checkpoint=ckpt).awaitTermination(300)
    bronze = lake.bronze.read()
    # The second run saw only the new file: its batch id is on exactly those rows.
    by_batch = {r.batch_id: r["count"] for r in bronze.groupBy("batch_id").count().collect()}
    assert sorted(by_batch.values()) == sorted([first, trips.count() - first])
    assert all(lake.bronze.has_batch(b) for b in by_batch)

    # A third run with no new file commits nothing.
    start_incremental(lake, landing, clock=clock, checkpoint=ckpt).awaitTermination(300)
    assert lake.bronze.read().select("batch_id").distinct().count() == 2
    assert lake.bronze.read().count() == trips.count()

    one = Lakehouse(spark, f"{workdir}/one")
    one.run_batch(trips, "all", dt.datetime(2024, 3, 1))
    cols = [c for c in SILVER_SCHEMA.fieldNames() if c not in AUDIT]
    assert rows(lake.silver.read(), cols) == rows(one.silver.read(), cols)
    assert lake.gold.read().count() == one.gold.read().count()


def test_one_run_splits_new_files_into_micro_batches(spark, workdir):
    trips = as_trips(read_table(spark, SF_SMALL, "lineitem"))
    landing = f"{workdir}/landing"
    for t in (1, 2, 3):
        trips.where(f"payment_type = {t}").coalesce(1).write.parquet(f"{landing}/m{t}")
    lake = Lakehouse(spark, f"{workdir}/lake")
    start_incremental(lake, landing, clock=clock, checkpoint=f"{workdir}/ckpt",
                      max_files_per_trigger=1).awaitTermination(300)
    assert lake.bronze.read().select("batch_id").distinct().count() == 3
    assert lake.silver.read().count() == trips.where("payment_type <= 3").count()


def test_latest_attempts_go_on_from_the_checkpoint(spark, workdir):
    from pyspark.sql import functions as F
    from tierlake.operators.oplog import deduplicate
    from tierlake.schemas import OPLOG_SCHEMA
    from tierlake.streaming.log_state import follow_log, latest_table

    def d(n):
        return dt.datetime(2024, 1, n)

    source, root = f"{workdir}/log", f"{workdir}/latest"
    first = [("a", "u", "failed", d(2), "x"), ("a", "u", "done", d(1), None), ("b", "u", "failed", d(5), "tie"), ("b", "u", "failed", d(5), "tie2"),
             ("c", "u", "failed", None, "undated"), (None, "u", "failed", d(1), "nameless")]
    second = [("a", "u", "late", d(1), "older than what is known"), ("c", "u", "done", d(1), None), ("d", "u", "failed", d(9), ""),
              ("b", "u", "failed", d(5), "tie3"), (None, "u", "failed", None, "late")]
    first += [("hot", "u", "failed", d(3) + dt.timedelta(seconds=k), str(k)) for k in range(15_000)]
    seen = []
    for n, part in enumerate((first, second, [])):
        if part:
            spark.createDataFrame(part, OPLOG_SCHEMA).coalesce(1).write.parquet(f"{source}/part{n}")
        query = follow_log(spark, source, root, checkpoint=f"{workdir}/ckpt")
        query.awaitTermination(300)
        seen.append(sum(p["numInputRows"] for p in query.recentProgress))
        rows_now = spark.createDataFrame(first + (second if n else []), OPLOG_SCHEMA)
        assert sorted(map(tuple, latest_table(spark, root).read().collect()), key=repr) == sorted(map(tuple, deduplicate(rows_now).collect()), key=repr)
    # Each run read only what was new.
    assert seen == [len(first), len(second), 0]
    # A fresh checkpoint over the same table starts anew and comes to the same rows.
    before = sorted(map(tuple, latest_table(spark, root).read().collect()), key=repr)
    follow_log(spark, source, root, checkpoint=f"{workdir}/ckpt2").awaitTermination(300)
    assert sorted(map(tuple, latest_table(spark, root).read().collect()), key=repr) == before
    assert latest_table(spark, root).read().where(F.col("fileName") == "hot").count() == 1
