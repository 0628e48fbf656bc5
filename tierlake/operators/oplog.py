"""The operations log: one row per download/upload attempt of a monthly file.

Columns: fileName, downloadURL, status, updated_date, error (``OPLOG_SCHEMA``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierlake.operators.latest import keep_latest, latest_per_key
from tierlake.schemas import FAILED_STATUS, OPLOG_SCHEMA


def failed_count(log: DataFrame, file_name: str) -> DataFrame:
    """One row: how many failed attempts ``file_name`` has (filters push to the scan)."""
    return (log.where((F.col("fileName") == file_name) & (F.col("status") == FAILED_STATUS))
            .agg(F.count(F.lit(1)).alias("failed_count")))


def insert_if_absent(log: DataFrame, new_rows: DataFrame) -> DataFrame:
    """New rows whose file is not in the log yet (``INSERT ... WHERE NOT EXISTS``).

    A row with a NULL file name never matches, so it is always inserted.
    """
    known = log.select("fileName").where(F.col("fileName").isNotNull()).distinct()
    return new_rows.select(*OPLOG_SCHEMA.fieldNames()).join(known, "fileName", "left_anti")


def append_if_absent(log: DataFrame, new_rows: DataFrame) -> DataFrame:
    """The log after :func:`insert_if_absent` has been appended."""
    return log.select(*OPLOG_SCHEMA.fieldNames()).unionByName(insert_if_absent(log, new_rows))


def latest_update(log: DataFrame) -> DataFrame:
    """``max(updated_date)`` per file."""
    return latest_per_key(log, "fileName", "updated_date", "updated_date")


def deduplicate(log: DataFrame) -> DataFrame:
    """Keep each file's latest row(s); see :func:`operators.latest.keep_latest`."""
    return keep_latest(log, "fileName", "updated_date")


def retry_candidates(log: DataFrame) -> DataFrame:
    """Files whose latest logged status is a failure: they are due for another try."""
    return deduplicate(log).where(F.col("status") == FAILED_STATUS)
