"""Inputs: monthly file scans, object listings and the test-table stand-ins."""

from tierlake.sources.files import drop_unstable, read_parquet, read_trip_files
from tierlake.sources.listing import files_of_year, list_files, year_folders

__all__ = ["drop_unstable", "files_of_year", "list_files", "read_parquet",
           "read_trip_files", "year_folders"]
