"""Trips that share pickup, dropoff and amount, the bronze key, go through the queries with the rows of their SQL."""

import datetime as dt

import duckdb
import pytest

import __spark_entry__ as entry_mod
from tierlake.operators.merge import CARDINALITY_MESSAGE, MergeCardinalityError
from tierlake.plans.lakehouse import Lakehouse

from test_entry import _digest
from test_stored_layers import NOW, trip

LINES = "l_suppkey long, l_partkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_tax double, l_shipdate timestamp_ntz"


def shared(spark, sf):
    """A lineitem of lines 1 to 7 that three suppliers (of ten, one's trips move) have alike; where it lies."""
    lines = [(3 + 7 * copy, 20 + 100 * copy, line, float(line % 3), 100.0 + day, 0.02, dt.datetime(2024, 1, 30) + dt.timedelta(days=day))
             for copy in range(3) for line in range(1, 8) for day in range(line % 2 + 2)]
    lines = [(*row[:4], row[4] + row[2], *row[5:]) for row in lines]
    spark.createDataFrame(lines, LINES).coalesce(1).write.parquet(f"{sf}/lineitem.parquet")
    return sf


@pytest.mark.parametrize("name", ["lakehouse_gold", "lakehouse_gold_daily", "merge_bronze", "lakehouse_silver",
                                  "silver_from_new_batches"])
def test_queries_have_the_rows_of_their_sql(spark, workdir, name):
    sf = shared(spark, f"{workdir}/sf")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW lineitem AS SELECT * FROM read_parquet('{sf}/lineitem.parquet/*.parquet')")
    want = con.execute(entry_mod.oracle_sql()[name])
    cols, want = [d[0] for d in want.description], want.fetchall()
    df = entry_mod.queries()[name](spark, sf)
    got = [tuple(r) for r in df.collect()]
    assert len(got) == len(want) > 0 and _digest(df.columns, got) == _digest(cols, want)


def test_a_batch_updates_its_own_trips_of_a_shared_key(spark, workdir):
    lake = Lakehouse(spark, f"{workdir}/lake")
    lake.run_batch(trip(spark).union(trip(spark, VendorID=2)), "b1", NOW)
    lake.run_batch(trip(spark, trip_distance=7.0).union(trip(spark, VendorID=3)), "b2", NOW)
    for rows in (lake.bronze.read(), lake.silver.read()):
        assert sorted((r.VendorID, r.trip_distance, r.batch_id) for r in rows.collect()) == [(1, 7.0, "b2"), (2, 2.0, "b1"), (3, 2.0, "b2")]
    # The same trip twice is still what MERGE refuses.
    with pytest.raises(MergeCardinalityError, match=CARDINALITY_MESSAGE):
        lake.run_batch(trip(spark).union(trip(spark)), "b3", NOW)
