"""Table schemas of the three layers, the operations log and the replay log.

All timestamps are zone-less (``timestamp_ntz``): the string form of a zoned
timestamp follows the session time zone, and the silver surrogate key hashes
timestamps as strings.
"""

from __future__ import annotations

from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

TS = TimestampNTZType()

AUDIT_FIELDS = [
    StructField("batch_id", StringType()),
    StructField("updated_date", TS),
    StructField("ingested_date", TS),
]
AUDIT_COLUMNS = [f.name for f in AUDIT_FIELDS]

# Columns of one monthly trip file as the pipeline expects to receive them
# (before audit columns). ``airport_fee`` is present in some files only and is
# dropped on load.
RAW_TRIP_FIELDS = [
    StructField("VendorID", LongType()),
    StructField("tpep_pickup_datetime", TS),
    StructField("tpep_dropoff_datetime", TS),
    StructField("passenger_count", IntegerType()),
    StructField("trip_distance", DoubleType()),
    StructField("RatecodeID", IntegerType()),
    StructField("store_and_fwd_flag", StringType()),
    StructField("PULocationID", IntegerType()),
    StructField("DOLocationID", IntegerType()),
    StructField("payment_type", IntegerType()),
    StructField("fare_amount", DoubleType()),
    StructField("extra", DoubleType()),
    StructField("mta_tax", DoubleType()),
    StructField("tip_amount", DoubleType()),
    StructField("tolls_amount", DoubleType()),
    StructField("improvement_surcharge", DoubleType()),
    StructField("total_amount", DoubleType()),
    StructField("congestion_surcharge", DoubleType()),
]
RAW_TRIP_SCHEMA = StructType(RAW_TRIP_FIELDS)

BRONZE_SCHEMA = StructType(RAW_TRIP_FIELDS + AUDIT_FIELDS)
BRONZE_KEYS = ["tpep_pickup_datetime", "tpep_dropoff_datetime", "total_amount"]
# Trips can share a bronze key; the other columns of a trip's id tell them apart.
BRONZE_TELL_APART = ["VendorID", "PULocationID", "DOLocationID", "payment_type"]
# Storage layout: bronze is partitioned by pickup month, which its key determines.
BRONZE_LAYOUT = {"pickup_month": "date_format(tpep_pickup_datetime, 'yyyy-MM')"}

# The columns the silver layer keeps, in the order they are selected.
SILVER_COLUMNS = [
    "VendorID",
    "pickup_datetime",
    "dropoff_datetime",
    "trip_distance",
    "PULocationID",
    "DOLocationID",
    "payment_type",
    "total_amount",
]
SILVER_SCHEMA = StructType([
    StructField("VendorID", IntegerType()),
    StructField("pickup_datetime", TS),
    StructField("dropoff_datetime", TS),
    StructField("trip_distance", DoubleType()),
    StructField("PULocationID", IntegerType()),
    StructField("DOLocationID", IntegerType()),
    StructField("payment_type", IntegerType()),
    StructField("total_amount", DoubleType()),
    StructField("trip_id", StringType()),
    *AUDIT_FIELDS,
])
SILVER_KEYS = ["trip_id"]
# Silver is partitioned by pickup month too. trip_id hashes the pickup time, so
# equal ids mean equal pickup months whenever the hashed columns have no NULL
# (with NULLs skipped, values can shift position between rows).
SILVER_LAYOUT = {"pickup_month": "date_format(pickup_datetime, 'yyyy-MM')"}
SILVER_LOCAL_CHECK = " AND ".join(
    f"{c} IS NOT NULL" for c in ("VendorID", "pickup_datetime", "dropoff_datetime",
                                 "PULocationID", "DOLocationID", "payment_type",
                                 "total_amount"))

GOLD_SCHEMA = StructType([
    StructField("id", StringType()),
    StructField("year", IntegerType()),
    StructField("month", IntegerType()),
    StructField("day", IntegerType()),
    StructField("total_revenue", DoubleType()),
    *AUDIT_FIELDS,
])
GOLD_KEYS = ["id"]
GOLD_PARTITIONS = ["year", "month", "day"]

# Daily revenue roll-up of gold, maintained per batch for the days it touches.
GOLD_DAILY_SCHEMA = StructType([
    StructField("year", IntegerType()),
    StructField("month", IntegerType()),
    StructField("day", IntegerType()),
    StructField("total_revenue", DoubleType()),
    StructField("trip_count", LongType()),
    *AUDIT_FIELDS,
])
GOLD_DAILY_KEYS = ["year", "month", "day"]
GOLD_DAILY_PARTITIONS = ["year", "month"]

OPLOG_SCHEMA = StructType([
    StructField("fileName", StringType()),
    StructField("downloadURL", StringType()),
    StructField("status", StringType()),
    StructField("updated_date", TS),
    StructField("error", StringType()),
])

REPLAY_LOG_SCHEMA = StructType([
    StructField("batch_id", StringType()),
    StructField("error", StringType()),
])

# The one status the downloader writes, and the bronze column
# that only some monthly files carry.
FAILED_STATUS = "failed"
UNSTABLE_COLUMN = "airport_fee"


def ddl(schema: StructType, table: str, location: str | None = None,
        partitioned_by: list[str] | None = None) -> str:
    """``CREATE TABLE`` text for one of the schemas above (Parquet data source)."""
    cols = ",\n  ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    text = f"CREATE TABLE {table} (\n  {cols}\n) USING parquet"
    if partitioned_by:
        text += " PARTITIONED BY (" + ", ".join(partitioned_by) + ")"
    if location:
        text += f" LOCATION '{location}'"
    return text
