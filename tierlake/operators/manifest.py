"""File manifest: which monthly files are expected, present, missing, incomplete
or due for a retry. Everything is a DataFrame; nothing is listed or compared on
the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierlake.functions.files import (
    DEFAULT_BASE_URL,
    basename,
    monthly_file_name,
    monthly_folder,
    monthly_url,
)
from tierlake.operators.oplog import retry_candidates


def year_range(spark: SparkSession, start_year: int, end_year: int) -> DataFrame:
    """A one-row ``(start_year, end_year)`` frame for a fixed range."""
    return spark.range(1).select(F.lit(start_year).cast("int").alias("start_year"),
                                 F.lit(end_year).cast("int").alias("end_year"))


def expected_files(ranges: DataFrame, base_url: str = DEFAULT_BASE_URL) -> DataFrame:
    """One row per month of every ``(start_year, end_year)`` row of ``ranges``.

    Columns: year, month, file_name, folder, url.
    """
    months = ranges.select(F.explode(F.sequence(
        F.make_date("start_year", F.lit(1), F.lit(1)),
        F.make_date("end_year", F.lit(12), F.lit(1)),
        F.expr("INTERVAL 1 MONTH"))).alias("m"))
    y, m = F.year("m").cast("int"), F.month("m").cast("int")
    return months.select(
        y.alias("year"), m.alias("month"),
        monthly_file_name(y, m).alias("file_name"),
        monthly_folder(y).alias("folder"),
        monthly_url(y, m, base_url).alias("url"),
    )


def present_from_listing(listing: DataFrame) -> DataFrame:
    """``file_name`` of every file in a listing (``sources.listing.list_files``)."""
    return listing.select(basename("path").alias("file_name"))


def missing_files(expected: DataFrame, present: DataFrame) -> DataFrame:
    """Expected files with no present file of the same name."""
    return expected.join(present.select("file_name").distinct(), "file_name", "left_anti")


def download_plan(expected: DataFrame, present: DataFrame, log: DataFrame) -> DataFrame:
    """Expected files that are missing, plus expected files whose latest logged
    attempt failed. Columns: those of ``expected`` and ``reason``."""
    missing = missing_files(expected, present).withColumn("reason", F.lit("missing"))
    failed = retry_candidates(log).select(F.col("fileName").alias("file_name"))
    retry = (expected.join(failed, "file_name", "left_semi")
             .join(missing.select("file_name"), "file_name", "left_anti")
             .withColumn("reason", F.lit("retry")))
    return missing.unionByName(retry)


def completeness(declared: DataFrame, listing: DataFrame) -> DataFrame:
    """Compare declared lengths (``file_name``, ``declared_length``) with the stored
    files (``sources.listing.list_files`` rows).

    A file is complete when it is stored and its byte count equals the declared
    length; a missing declared length counts as complete.
    Columns: file_name, declared_length, length, complete.
    """
    stored = listing.select(basename("path").alias("file_name"), "length")
    j = declared.join(stored, "file_name", "left")
    ok = F.col("length").isNotNull() & (
        F.col("declared_length").isNull() | (F.col("declared_length") == F.col("length")))
    return j.select("file_name", "declared_length", "length", ok.alias("complete"))


def plan_downloads(spark: SparkSession, listing: DataFrame, log: DataFrame,
                   start_year: int, end_year: int, base_url: str = DEFAULT_BASE_URL
                   ) -> DataFrame:
    """What the downloader should fetch for ``[start_year, end_year]``: every
    expected monthly file that is not stored, plus stored ones whose latest
    logged attempt failed. ``listing`` comes from ``sources.listing.list_files``."""
    expected = expected_files(year_range(spark, start_year, end_year), base_url)
    return download_plan(expected, present_from_listing(listing), log)
