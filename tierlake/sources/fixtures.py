"""Stand-ins that let the driver's test tables play the pipeline's inputs.

``lineitem`` plays a monthly trip file, ``events`` the operations log. The
mappings are plain projections, so every query over them scales with the
tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierlake.functions.files import DEFAULT_BASE_URL, monthly_file_name
from tierlake.schemas import FAILED_STATUS

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations"]


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def as_trips(lineitem: DataFrame) -> DataFrame:
    """``lineitem`` as a raw monthly trip file (core columns + ``airport_fee``).

    VendorID ← l_suppkey, pickup ← l_shipdate, dropoff ← l_shipdate plus
    l_quantity hours, trip_distance ← l_quantity, PU/DO location ← l_partkey /
    l_suppkey, payment_type ← l_linenumber, total_amount ← l_extendedprice,
    airport_fee ← l_tax.
    """
    return lineitem.select(
        F.col("l_suppkey").alias("VendorID"),
        F.col("l_shipdate").alias("tpep_pickup_datetime"),
        F.timestamp_add("HOUR", F.col("l_quantity").cast("long"), F.col("l_shipdate"))
        .alias("tpep_dropoff_datetime"),
        F.col("l_quantity").alias("trip_distance"),
        F.col("l_partkey").cast("int").alias("PULocationID"),
        F.col("l_suppkey").cast("int").alias("DOLocationID"),
        F.col("l_linenumber").alias("payment_type"),
        F.col("l_extendedprice").alias("total_amount"),
        F.col("l_tax").alias("airport_fee"),
    )


def as_oplog(events: DataFrame, base_url: str = DEFAULT_BASE_URL) -> DataFrame:
    """``events`` as operations-log rows: one file per user, an ``error`` event is
    a failed attempt."""
    name = F.concat(F.lit("file_"), F.col("user_id").cast("string"))
    return events.select(
        name.alias("fileName"),
        F.concat(F.lit(base_url), name).alias("downloadURL"),
        F.when(F.col("event_type") == "error", F.lit(FAILED_STATUS))
        .otherwise(F.col("event_type")).alias("status"),
        F.col("ts").alias("updated_date"),
        F.col("props").alias("error"),
    )


def shipped_files(lineitem: DataFrame) -> DataFrame:
    """Monthly file names of the months that have shipments (the files present)."""
    d = F.col("l_shipdate")
    return lineitem.select(monthly_file_name(F.year(d), F.month(d)).alias("file_name")).distinct()


def ship_year_range(lineitem: DataFrame, extra_years: int = 0) -> DataFrame:
    """``(start_year, end_year)`` spanning the shipments, plus ``extra_years``."""
    return lineitem.agg(F.year(F.min("l_shipdate")).alias("start_year"),
                        (F.year(F.max("l_shipdate")) + extra_years).alias("end_year"))


def lake_batches(trips: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Two batches of trips for the stored layers.

    The first: payment types up to 5, where one vendor in ten has no dropoff. The second: types
    from 4 on with doubled distance (4 and 5 are in both), where those vendors' trips have the time
    as dropoff and no pickup. Ids skip NULLs, so such a trip keeps its id and moves to other partitions.
    """
    some = F.col("VendorID") % 10 == 0
    pickup, dropoff = "tpep_pickup_datetime", "tpep_dropoff_datetime"
    first = trips.where("payment_type <= 5").withColumn(dropoff, F.when(~some, F.col(dropoff)))
    second = (trips.where("payment_type >= 4").withColumn("trip_distance", F.col("trip_distance") * 2)
              .withColumns({pickup: F.when(~some, F.col(pickup)), dropoff: F.when(some, F.col(pickup)).otherwise(F.col(dropoff))}))
    return first, second
