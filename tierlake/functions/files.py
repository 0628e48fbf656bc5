"""File-name and URL expressions of the monthly trip files."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tierlake.functions.calendar import zero_padded_month

# The public download location and the file-name pattern of the
# monthly yellow-taxi files, and the object-store folder they are kept under.
DEFAULT_BASE_URL = "https://d37ci6vzurychx.cloudfront.net/trip-data/"
FILE_PREFIX = "yellow_tripdata_"
FILE_SUFFIX = ".parquet"
FOLDER_PREFIX = "parquetfiles/"


def _c(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


def monthly_file_name(year: str | Column, month: str | Column) -> Column:
    """``yellow_tripdata_<yyyy>-<MM>.parquet``."""
    return F.concat(F.lit(FILE_PREFIX), _c(year).cast("string"), F.lit("-"),
                    zero_padded_month(month), F.lit(FILE_SUFFIX))


def monthly_folder(year: str | Column) -> Column:
    """``parquetfiles/<yyyy>`` — the folder a month's file is uploaded to."""
    return F.concat(F.lit(FOLDER_PREFIX), _c(year).cast("string"))


def monthly_url(year: str | Column, month: str | Column,
                base_url: str = DEFAULT_BASE_URL) -> Column:
    return F.concat(F.lit(base_url), monthly_file_name(year, month))


def basename(url: str | Column) -> Column:
    """Text after the last ``/`` (the whole string when there is none).

    Query strings and fragments are kept, as a plain last-slash split does.
    """
    return F.substring_index(_c(url), "/", -1)
