"""Registered queries over the driver's test tables, and their SQL oracles.

Every query reads whole tables from ``sf_dir`` through the stand-ins in
``sources.fixtures``: lineitem plays the monthly trip files, events the
operations log, pages the download URLs. Each oracle is DuckDB SQL over the
same tables that computes the same result independently of the DataFrame code.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tierlake.functions.files import DEFAULT_BASE_URL, basename
from tierlake.functions.time import ntz_literal
from tierlake.operators import oplog
from tierlake.operators.audit import stamp_audit
from tierlake.operators.manifest import completeness, expected_files, missing_files, present_from_listing
from tierlake.operators.merge import merge_upsert
from tierlake.operators.quality import quality_report
from tierlake.plans.layers import (
    bronze_batch,
    bronze_rows,
    gold_batch,
    gold_daily_revenue,
    gold_trip_revenue,
    silver_batch,
    silver_project,
    silver_transform,
    top_rows,
)
from tierlake.plans.lakehouse import Lakehouse
from tierlake.plans.operations_log import OperationsLog
from tierlake.schemas import BRONZE_KEYS, BRONZE_SCHEMA, GOLD_KEYS, SILVER_KEYS
from tierlake.session import scratch_path
from tierlake.sinks.catalog_tables import append_rows, create_table, extract_batch
from tierlake.sources.files import read_trip_files
from tierlake.sources.listing import list_files
from tierlake.streaming.log_state import follow_log, latest_table
from tierlake.sources.fixtures import (
    TABLES,
    as_oplog,
    as_trips,
    lake_batches,
    read_table,
    ship_year_range,
    shipped_files,
    table_path,
)

# Fixed parameters of the test queries.
T1, T2 = "2024-01-01 00:00:00", "2024-02-01 00:00:00"      # clocks of batch b1, b2
CLOCKS = [dt.datetime.fromisoformat(t) for t in (T1, T2)]
# Every event is on one side: logged before, or new from then on.
LOG_CUT = "2024-01-10 00:00:00"
PROBE_FILE = "file_8"
TOP_N = 10

Query = Callable[[SparkSession, str], DataFrame]


# ---- shared inputs ----------------------------------------------------------


def _bronze(spark: SparkSession, sf: str) -> DataFrame:
    return bronze_rows(as_trips(read_table(spark, sf, "lineitem")))


def _split(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Merge fixture: target = trips paid with type ≤ 5, source = type ≥ 4 with
    doubled distance (types 4 and 5 are in both: the matched rows)."""
    b = _bronze(spark, sf)
    target = b.where(F.col("payment_type") <= 5)
    source = (b.where(F.col("payment_type") >= 4)
              .withColumn("trip_distance", F.col("trip_distance") * 2))
    return target, source


def _oplog(spark: SparkSession, sf: str) -> DataFrame:
    return as_oplog(read_table(spark, sf, "events"))


# ---- queries ----------------------------------------------------------------


def q_scan_bronze(spark, sf):
    # Monthly files of two physical schemas: a narrow vendor without the fee, a wide one with it.
    landing = scratch_path(spark, "landing")
    trips = as_trips(read_table(spark, sf, "lineitem"))
    (trips.where("payment_type <= 3").withColumn("VendorID", F.col("VendorID").cast("int")).drop("airport_fee")
     .write.parquet(f"{landing}/early"))
    trips.where("payment_type > 3").write.parquet(f"{landing}/late")
    return bronze_rows(read_trip_files(spark, landing))


def q_present_files(spark, sf):
    return present_from_listing(list_files(spark, [table_path(sf, t) for t in TABLES], "*")
                                .select(F.regexp_extract("path", r"([^/]+\.parquet)(/part-[^/]*)?$", 1).alias("path"))).distinct()


def q_file_completeness(spark, sf):
    # Declared: the stored length, for one table a byte more, for one unknown, and a file that is not there.
    stored = list_files(spark, [table_path(sf, t) for t in TABLES], "*").withColumn("path", F.regexp_extract("path", r"([^/]+\.parquet)(/part-[^/]*)?$", 1)) \
        .groupBy("path").agg(F.sum("length").alias("length"))
    declared = stored.select(F.col("path").alias("file_name"), F.when(F.col("path") == "orders.parquet", F.col("length") + 1)
                             .when(F.col("path") != "events.parquet", F.col("length")).alias("declared_length"))
    absent = spark.range(1).select(F.lit("absent.parquet").alias("file_name"), F.lit(1).cast("long").alias("declared_length"))
    return completeness(declared.unionByName(absent), stored).select("file_name", "complete")


def q_log_stream_latest(spark, sf):
    root = scratch_path(spark, "log-latest")
    schema = read_table(spark, sf, "events").schema
    follow_log(spark, sf, root, pattern="events.parquet", checkpoint=scratch_path(spark, "log-checkpoint"),
               read=as_oplog, schema=schema).awaitTermination()
    return latest_table(spark, root).read()


def q_scan_with_lineage(spark, sf):
    schema = StructType([StructField("o_orderkey", LongType()),
                         StructField("l_orderkey", LongType())])
    df = read_trip_files(spark, [table_path(sf, "orders"), table_path(sf, "lineitem")],
                         schema, lineage_col="file_name")
    return df.groupBy("file_name").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum(F.coalesce("o_orderkey", "l_orderkey")).alias("key_sum"))


def q_file_row_counts(spark, sf):
    counts = [spark.read.parquet(table_path(sf, t)).agg(F.count(F.lit(1)).alias("n_rows"))
              .select(F.lit(t).alias("table_name"), "n_rows") for t in TABLES]
    return reduce(lambda a, b: a.unionByName(b), counts)


def q_silver_project(spark, sf):
    return silver_project(_bronze(spark, sf))


def q_silver_trip_id(spark, sf):
    return silver_transform(_bronze(spark, sf))


def q_conform_schema(spark, sf):
    return silver_batch(_bronze(spark, sf), "b1", T1)


def q_gold_trip_revenue(spark, sf):
    return gold_trip_revenue(silver_transform(_bronze(spark, sf)))


def q_gold_daily_revenue(spark, sf):
    return gold_daily_revenue(silver_transform(_bronze(spark, sf)))


def q_gold_limit(spark, sf):
    return top_rows(gold_trip_revenue(silver_transform(_bronze(spark, sf))), TOP_N,
                    ["id", "year", "month", "day"])


def q_merge_bronze(spark, sf):
    # Trips can share pickup, dropoff and amount; the SQL then has each target row with each source row.
    t, s = _split(spark, sf)
    return merge_upsert(stamp_audit(t, "b1", T1), stamp_audit(s, "b2", T2), BRONZE_KEYS,
                        preserve=["ingested_date"], on_several="each")


def q_merge_silver(spark, sf):
    t, s = _split(spark, sf)
    return merge_upsert(silver_batch(t, "b1", T1), silver_batch(s, "b2", T2), SILVER_KEYS,
                        preserve=["ingested_date"])


def q_merge_gold(spark, sf):
    t, s = _split(spark, sf)
    return merge_upsert(gold_batch(silver_transform(t), "b1", T1),
                        gold_batch(silver_transform(s), "b2", T2), GOLD_KEYS,
                        preserve=["ingested_date"])


def q_table_scan(spark, sf):
    name = f"spark_catalog.default.trip_info_b_{uuid.uuid4().hex}"
    create_table(spark, name, BRONZE_SCHEMA, scratch_path(spark, "trip_info_b"))
    for batch, rows in zip(("b1", "b2"), _split(spark, sf)):
        append_rows(bronze_batch(rows, batch, T1), name)
    return extract_batch(spark, name, "b2")


def _lake(spark: SparkSession, **options) -> Lakehouse:
    # The batches hold rows without a pickup or dropoff on purpose.
    return Lakehouse(spark, scratch_path(spark, "lakehouse"), blocking_rules=(), **options)


def _two_batches(spark: SparkSession, sf: str, lake: Lakehouse) -> Lakehouse:
    for batch, now, rows in zip(("b1", "b2"), CLOCKS, lake_batches(as_trips(read_table(spark, sf, "lineitem")))):
        lake.run_batch(rows, batch, now)
    return lake


def q_lakehouse_silver(spark, sf):
    lake = _lake(spark)
    for batch, now, rows in zip(("b1", "b2"), CLOCKS, lake_batches(as_trips(read_table(spark, sf, "lineitem")))):
        lake.bronze_to_silver(lake.load_bronze(rows, batch, now), batch, now)
    return lake.silver.read()


def q_silver_from_new_batches(spark, sf):
    lake = _lake(spark)
    for batch, now, rows in zip(("b1", "b2"), CLOCKS, lake_batches(as_trips(read_table(spark, sf, "lineitem")))):
        lake.load_bronze(rows, batch, now)
    lake.silver_from_new_batches(CLOCKS[1])
    return lake.silver.read().drop("updated_date", "ingested_date")


def q_lakehouse_gold(spark, sf):
    return _two_batches(spark, sf, _lake(spark)).gold.read()


def q_lakehouse_gold_daily(spark, sf):
    return _two_batches(spark, sf, _lake(spark, daily_rollup=True)).gold_daily.read().select(
        "year", "month", "day", "total_revenue", "trip_count")


def q_log_failed_count(spark, sf):
    log = OperationsLog(spark, scratch_path(spark, "operations-log"))
    log.append(_oplog(spark, sf))
    return oplog.failed_count(log.read(), PROBE_FILE)


def q_log_insert_if_absent(spark, sf):
    log = _oplog(spark, sf)
    existing = log.where(F.col("updated_date") < ntz_literal(LOG_CUT))
    new = log.where(F.col("updated_date") >= ntz_literal(LOG_CUT))
    return oplog.append_if_absent(existing, new)


def q_log_latest_ts(spark, sf):
    return oplog.latest_update(_oplog(spark, sf))


def q_log_dedup_latest(spark, sf):
    return oplog.deduplicate(_oplog(spark, sf))


def q_expected_files(spark, sf):
    return expected_files(ship_year_range(read_table(spark, sf, "lineitem")))


def q_missing_months(spark, sf):
    li = read_table(spark, sf, "lineitem")
    return missing_files(expected_files(ship_year_range(li, extra_years=1)), shipped_files(li))


def q_retry_candidates(spark, sf):
    return oplog.retry_candidates(_oplog(spark, sf))


def q_url_basename(spark, sf):
    pages = read_table(spark, sf, "pages")
    return pages.select("page_id", "url", basename("url").alias("file_name"))


def q_quality_report(spark, sf):
    return quality_report(silver_transform(_bronze(spark, sf)))


QUERIES: dict[str, Query] = {
    "scan_bronze": q_scan_bronze,
    "scan_with_lineage": q_scan_with_lineage,
    "file_row_counts": q_file_row_counts,
    "present_files": q_present_files,
    "file_completeness": q_file_completeness,
    "log_stream_latest": q_log_stream_latest,
    "silver_project": q_silver_project,
    "silver_trip_id": q_silver_trip_id,
    "conform_schema": q_conform_schema,
    "gold_trip_revenue": q_gold_trip_revenue,
    "gold_daily_revenue": q_gold_daily_revenue,
    "gold_limit": q_gold_limit,
    "merge_bronze": q_merge_bronze,
    "merge_silver": q_merge_silver,
    "merge_gold": q_merge_gold,
    "table_scan": q_table_scan,
    "lakehouse_silver": q_lakehouse_silver,
    "silver_from_new_batches": q_silver_from_new_batches,
    "lakehouse_gold": q_lakehouse_gold,
    "lakehouse_gold_daily": q_lakehouse_gold_daily,
    "log_failed_count": q_log_failed_count,
    "log_insert_if_absent": q_log_insert_if_absent,
    "log_latest_ts": q_log_latest_ts,
    "log_dedup_latest": q_log_dedup_latest,
    "expected_files": q_expected_files,
    "missing_months": q_missing_months,
    "retry_candidates": q_retry_candidates,
    "url_basename": q_url_basename,
    "quality_report": q_quality_report,
}


# ---- DuckDB oracles ---------------------------------------------------------

_TRIPS = """trips AS (
  SELECT l_suppkey AS VendorID,
         l_shipdate AS tpep_pickup_datetime,
         l_shipdate + to_hours(CAST(l_quantity AS BIGINT)) AS tpep_dropoff_datetime,
         l_quantity AS trip_distance,
         CAST(l_partkey AS INTEGER) AS PULocationID,
         CAST(l_suppkey AS INTEGER) AS DOLocationID,
         l_linenumber AS payment_type,
         l_extendedprice AS total_amount,
         l_tax AS airport_fee
  FROM lineitem),
bronze AS (SELECT * EXCLUDE (airport_fee) FROM trips)"""

_SILVER_COLS = """VendorID, tpep_pickup_datetime AS pickup_datetime,
  tpep_dropoff_datetime AS dropoff_datetime, trip_distance, PULocationID, DOLocationID,
  payment_type, total_amount"""

_TRIP_ID = """sha256(concat_ws('||', VendorID, pickup_datetime, dropoff_datetime,
  PULocationID, DOLocationID, payment_type, total_amount))"""

_SILVER = f"""silver AS (
  SELECT *, {_TRIP_ID} AS trip_id FROM (SELECT {_SILVER_COLS} FROM bronze))"""

_SPLIT = """tgt AS (SELECT * FROM bronze WHERE payment_type <= 5),
src AS (SELECT * REPLACE (trip_distance * 2 AS trip_distance) FROM bronze
        WHERE payment_type >= 4)"""


def _audit(batch: str, ts: str) -> str:
    return (f"'{batch}' AS batch_id, TIMESTAMP '{ts}' AS updated_date, "
            f"TIMESTAMP '{ts}' AS ingested_date")


def _silver_of(rel: str) -> str:
    return (f"SELECT *, {_TRIP_ID} AS trip_id FROM (SELECT {_SILVER_COLS} FROM {rel})")


def _gold_of(rel: str) -> str:
    return f"""SELECT trip_id AS id, CAST(year(dropoff_datetime) AS INTEGER) AS year,
  CAST(month(dropoff_datetime) AS INTEGER) AS month,
  CAST(day(dropoff_datetime) AS INTEGER) AS day, sum(total_amount) AS total_revenue
  FROM ({_silver_of(rel)}) GROUP BY ALL"""


def _merge_sql(t: str, s: str, keys: list[str]) -> str:
    on = " AND ".join(f"s.{k} = t.{k}" for k in keys)
    on_m = " AND ".join(f"s.{k} = m.{k}" for k in keys)
    return f"""WITH {_TRIPS}, {_SPLIT},
t AS ({t}), s AS ({s})
SELECT t.* FROM t WHERE NOT EXISTS (SELECT 1 FROM s WHERE {on})
UNION ALL
SELECT s.* REPLACE (COALESCE(m.ingested_date, s.ingested_date) AS ingested_date)
FROM s LEFT JOIN t AS m ON {on_m}"""


# The two batches of fixtures.lake_batches, and silver after both.
_LAKE = f"""{_TRIPS},
tgt AS (SELECT * REPLACE (CASE WHEN VendorID % 10 <> 0 THEN tpep_dropoff_datetime END AS tpep_dropoff_datetime)
        FROM bronze WHERE payment_type <= 5),
src AS (SELECT * REPLACE (trip_distance * 2 AS trip_distance,
                          CASE WHEN VendorID % 10 <> 0 THEN tpep_pickup_datetime END AS tpep_pickup_datetime,
                          CASE WHEN VendorID % 10 = 0 THEN tpep_pickup_datetime ELSE tpep_dropoff_datetime END AS tpep_dropoff_datetime)
        FROM bronze WHERE payment_type >= 4),
t AS (SELECT * REPLACE (CAST(VendorID AS INTEGER) AS VendorID), {_audit('b1', T1)} FROM ({_silver_of('tgt')})),
s AS (SELECT * REPLACE (CAST(VendorID AS INTEGER) AS VendorID), {_audit('b2', T2)} FROM ({_silver_of('src')})),
silver AS (SELECT t.* FROM t WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.trip_id = t.trip_id)
           UNION ALL
           SELECT s.* REPLACE (COALESCE(m.ingested_date, s.ingested_date) AS ingested_date) FROM s LEFT JOIN t AS m ON s.trip_id = m.trip_id),
gold AS (SELECT trip_id AS id, CAST(year(dropoff_datetime) AS INTEGER) AS year, CAST(month(dropoff_datetime) AS INTEGER) AS month,
                CAST(day(dropoff_datetime) AS INTEGER) AS day, sum(total_amount) AS total_revenue, max(batch_id) AS batch_id,
                max(updated_date) AS updated_date, min(ingested_date) AS ingested_date FROM silver GROUP BY ALL)"""

_OPLOG = f"""ol AS (
  SELECT concat('file_', CAST(user_id AS VARCHAR)) AS fileName,
         concat('{DEFAULT_BASE_URL}', 'file_', CAST(user_id AS VARCHAR)) AS downloadURL,
         CASE WHEN event_type = 'error' THEN 'failed' ELSE event_type END AS status,
         ts AS updated_date, props AS error
  FROM events)"""

_LATEST = f"""WITH {_OPLOG}
SELECT fileName, downloadURL, status, updated_date, error FROM ol
QUALIFY rank() OVER (PARTITION BY fileName ORDER BY updated_date DESC NULLS LAST) = 1"""

_MONTHS = """SELECT CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month,
  'yellow_tripdata_' || CAST(year(d) AS VARCHAR) || '-'
    || lpad(CAST(month(d) AS VARCHAR), 2, '0') || '.parquet' AS file_name,
  'parquetfiles/' || CAST(year(d) AS VARCHAR) AS folder,
  '{base}yellow_tripdata_' || CAST(year(d) AS VARCHAR) || '-'
    || lpad(CAST(month(d) AS VARCHAR), 2, '0') || '.parquet' AS url
FROM (SELECT unnest(generate_series(make_date(s, 1, 1), make_date(e, 12, 1),
                                    INTERVAL 1 MONTH)) AS d
      FROM (SELECT year(min(l_shipdate)) AS s, year(max(l_shipdate)) + {extra} AS e
            FROM lineitem))""".replace("{base}", DEFAULT_BASE_URL)

ORACLE_SQL: dict[str, str] = {
    "scan_bronze": f"""WITH {_TRIPS}
SELECT VendorID, tpep_pickup_datetime, tpep_dropoff_datetime, trip_distance, PULocationID, DOLocationID, payment_type, total_amount,
       CAST(NULL AS INTEGER) AS passenger_count, CAST(NULL AS INTEGER) AS RatecodeID, CAST(NULL AS VARCHAR) AS store_and_fwd_flag,
       {', '.join(f'CAST(NULL AS DOUBLE) AS {c}' for c in ('fare_amount', 'extra', 'mta_tax', 'tip_amount', 'tolls_amount', 'improvement_surcharge', 'congestion_surcharge'))}
FROM bronze""",
    "present_files": " UNION ALL ".join(f"SELECT '{t}.parquet' AS file_name" for t in TABLES),
    "file_completeness": " UNION ALL ".join(
        [f"SELECT '{t}.parquet' AS file_name, {'false' if t == 'orders' else 'true'} AS complete" for t in TABLES] +
        ["SELECT 'absent.parquet', false"]),
    "log_stream_latest": _LATEST,
    "scan_with_lineage": """
SELECT 'lineitem.parquet' AS file_name, count(*) AS n_rows,
       CAST(sum(l_orderkey) AS BIGINT) AS key_sum FROM lineitem
UNION ALL
SELECT 'orders.parquet', count(*), CAST(sum(o_orderkey) AS BIGINT) FROM orders""",
    "file_row_counts": "\nUNION ALL\n".join(
        f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM {t}" for t in TABLES),
    "silver_project": f"WITH {_TRIPS} SELECT {_SILVER_COLS} FROM bronze",
    "silver_trip_id": f"WITH {_TRIPS}, {_SILVER} SELECT * FROM silver",
    "conform_schema": f"""WITH {_TRIPS}, {_SILVER}
SELECT * REPLACE (CAST(VendorID AS INTEGER) AS VendorID), {_audit('b1', T1)} FROM silver""",
    "gold_trip_revenue": f"WITH {_TRIPS} {_gold_of('bronze')}",
    "gold_daily_revenue": f"""WITH {_TRIPS}, {_SILVER}
SELECT CAST(year(dropoff_datetime) AS INTEGER) AS year,
       CAST(month(dropoff_datetime) AS INTEGER) AS month,
       CAST(day(dropoff_datetime) AS INTEGER) AS day,
       CAST(sum(CAST(total_amount AS DECIMAL(18,2))) AS DOUBLE) AS total_revenue,
       count(*) AS trip_count
FROM silver GROUP BY ALL""",
    "gold_limit": f"""WITH {_TRIPS} SELECT * FROM ({_gold_of('bronze')})
ORDER BY id, year, month, day LIMIT {TOP_N}""",
    "merge_bronze": _merge_sql(f"SELECT *, {_audit('b1', T1)} FROM tgt",
                               f"SELECT *, {_audit('b2', T2)} FROM src", BRONZE_KEYS),
    "merge_silver": _merge_sql(
        f"SELECT * REPLACE (CAST(VendorID AS INTEGER) AS VendorID), {_audit('b1', T1)} "
        f"FROM ({_silver_of('tgt')})",
        f"SELECT * REPLACE (CAST(VendorID AS INTEGER) AS VendorID), {_audit('b2', T2)} "
        f"FROM ({_silver_of('src')})", SILVER_KEYS),
    "merge_gold": _merge_sql(f"SELECT *, {_audit('b1', T1)} FROM ({_gold_of('tgt')})",
                             f"SELECT *, {_audit('b2', T2)} FROM ({_gold_of('src')})",
                             GOLD_KEYS),
    "table_scan": f"""WITH {_TRIPS}, {_SPLIT}
SELECT VendorID, tpep_pickup_datetime, tpep_dropoff_datetime, CAST(NULL AS INTEGER) AS passenger_count, trip_distance,
       CAST(NULL AS INTEGER) AS RatecodeID, CAST(NULL AS VARCHAR) AS store_and_fwd_flag, PULocationID, DOLocationID, payment_type,
       {', '.join(f'CAST(NULL AS DOUBLE) AS {c}' for c in ('fare_amount', 'extra', 'mta_tax', 'tip_amount', 'tolls_amount', 'improvement_surcharge'))},
       total_amount, CAST(NULL AS DOUBLE) AS congestion_surcharge, {_audit('b2', T1)} FROM src""",
    "lakehouse_silver": f"WITH {_LAKE} SELECT * FROM silver",
    "silver_from_new_batches": f"WITH {_LAKE} SELECT * EXCLUDE (updated_date, ingested_date) FROM silver",
    "lakehouse_gold": f"WITH {_LAKE} SELECT * FROM gold",
    "lakehouse_gold_daily": f"""WITH {_LAKE}
SELECT year, month, day, CAST(sum(CAST(total_revenue AS DECIMAL(18,2))) AS DOUBLE) AS total_revenue, count(*) AS trip_count
FROM gold GROUP BY ALL""",
    "log_failed_count": f"""WITH {_OPLOG}
SELECT count(*) AS failed_count FROM ol WHERE fileName = '{PROBE_FILE}' AND status = 'failed'""",
    "log_insert_if_absent": f"""WITH {_OPLOG},
old AS (SELECT * FROM ol WHERE updated_date < TIMESTAMP '{LOG_CUT}'),
new AS (SELECT * FROM ol WHERE updated_date >= TIMESTAMP '{LOG_CUT}')
SELECT * FROM old
UNION ALL
SELECT * FROM new n WHERE NOT EXISTS (SELECT 1 FROM old o WHERE o.fileName = n.fileName)""",
    "log_latest_ts": f"""WITH {_OPLOG}
SELECT fileName, max(updated_date) AS updated_date FROM ol GROUP BY fileName""",
    "log_dedup_latest": _LATEST,
    "expected_files": _MONTHS.replace("{extra}", "0"),
    "missing_months": f"""SELECT * FROM ({_MONTHS.replace('{extra}', '1')}) e
WHERE e.file_name NOT IN (
  SELECT DISTINCT 'yellow_tripdata_' || CAST(year(l_shipdate) AS VARCHAR) || '-'
         || lpad(CAST(month(l_shipdate) AS VARCHAR), 2, '0') || '.parquet' FROM lineitem)""",
    "retry_candidates": f"SELECT * FROM ({_LATEST}) WHERE status = 'failed'",
    "url_basename": "SELECT page_id, url, regexp_extract(url, '[^/]*$') AS file_name FROM pages",
    "quality_report": f"""WITH {_TRIPS}, {_SILVER}
SELECT 'trip_id_not_null' AS rule,
       CAST(count(*) FILTER (WHERE trip_id IS NULL) AS BIGINT) AS violations FROM silver
UNION ALL SELECT 'key_columns_present', CAST(count(*) FILTER (WHERE pickup_datetime IS NULL
       OR dropoff_datetime IS NULL OR total_amount IS NULL) AS BIGINT) FROM silver
UNION ALL SELECT 'total_amount_non_negative',
       CAST(count(*) FILTER (WHERE total_amount < 0) AS BIGINT) FROM silver
UNION ALL SELECT 'dropoff_not_before_pickup',
       CAST(count(*) FILTER (WHERE dropoff_datetime < pickup_datetime) AS BIGINT) FROM silver
UNION ALL SELECT 'payment_type_known',
       CAST(count(*) FILTER (WHERE payment_type NOT BETWEEN 1 AND 6) AS BIGINT) FROM silver
UNION ALL SELECT 'trip_id_unique', CAST(COALESCE(sum(n - 1), 0) AS BIGINT)
  FROM (SELECT trip_id, count(*) AS n FROM silver WHERE trip_id IS NOT NULL
        GROUP BY trip_id HAVING count(*) > 1)""",
}
