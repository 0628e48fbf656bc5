"""The three layer transforms, as pure DataFrame → DataFrame functions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierlake.functions.calendar import day_parts
from tierlake.functions.keys import trip_id
from tierlake.operators.audit import stamp_audit
from tierlake.operators.conform import conform
from tierlake.schemas import BRONZE_SCHEMA, GOLD_SCHEMA, SILVER_COLUMNS, SILVER_SCHEMA
from tierlake.sources.files import drop_unstable

# ---- bronze -------------------------------------------------------------------


def bronze_rows(raw: DataFrame) -> DataFrame:
    """A raw trip file as bronze rows: ``VendorID`` widened to bigint, the
    unstable fee column dropped, every other column as it came."""
    return drop_unstable(raw.withColumn("VendorID", F.col("VendorID").cast("bigint")))


def bronze_batch(raw: DataFrame, batch_id: str, now: dt.datetime | str) -> DataFrame:
    """Bronze rows stamped and conformed to the full bronze schema."""
    return conform(stamp_audit(bronze_rows(raw), batch_id, now), BRONZE_SCHEMA,
                   fill_missing=True)


# ---- silver -------------------------------------------------------------------

RENAMES = {"tpep_pickup_datetime": "pickup_datetime",
           "tpep_dropoff_datetime": "dropoff_datetime"}


def silver_project(bronze: DataFrame) -> DataFrame:
    """Rename the pickup/dropoff columns and keep the eight silver columns."""
    return bronze.withColumnsRenamed(RENAMES).select(*SILVER_COLUMNS)


def silver_transform(bronze: DataFrame, null_token: str | None = None) -> DataFrame:
    """:func:`silver_project` plus the SHA-256 ``trip_id``."""
    return silver_project(bronze).withColumn("trip_id", trip_id(null_token))


def silver_batch(bronze: DataFrame, batch_id: str, now: dt.datetime | str,
                 null_token: str | None = None) -> DataFrame:
    """Silver rows stamped and conformed (``VendorID`` narrowed to INT, checked)."""
    return conform(stamp_audit(silver_transform(bronze, null_token), batch_id, now),
                   SILVER_SCHEMA)


# ---- gold ---------------------------------------------------------------------


def gold_trip_revenue(silver: DataFrame) -> DataFrame:
    """``sum(total_amount)`` per dropoff day and ``trip_id`` (the gold table rows).

    The group key holds ``trip_id``, so this is revenue per trip per day; see
    :func:`gold_daily_revenue` for the roll-up per day.
    """
    parts = day_parts("dropoff_datetime")
    return (silver.groupBy(F.col("trip_id").alias("id"), *[c.alias(n) for n, c in parts.items()])
            .agg(F.sum("total_amount").alias("total_revenue")))


def gold_daily_revenue(silver: DataFrame) -> DataFrame:
    """Revenue and trip count per dropoff day. Amounts are summed as
    DECIMAL(18,2), so the total does not depend on the order rows arrive in."""
    parts = day_parts("dropoff_datetime")
    return (silver.groupBy(*[c.alias(n) for n, c in parts.items()])
            .agg(F.sum(F.col("total_amount").cast("decimal(18,2)")).cast("double")
                 .alias("total_revenue"),
                 F.count(F.lit(1)).alias("trip_count")))


def gold_batch(silver: DataFrame, batch_id: str, now: dt.datetime | str) -> DataFrame:
    """Gold rows stamped and conformed to the gold schema."""
    return conform(stamp_audit(gold_trip_revenue(silver), batch_id, now), GOLD_SCHEMA)


def top_rows(df: DataFrame, n: int, order_by: list[str] | str = "id") -> DataFrame:
    """The first ``n`` rows in a total order (planned as a top-k, not a sort)."""
    cols = [order_by] if isinstance(order_by, str) else order_by
    return df.orderBy(*cols).limit(n)
