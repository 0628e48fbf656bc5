"""Column expressions used by the layers (all built-in Spark functions, no UDFs)."""

from tierlake.functions.calendar import day_parts, zero_padded_month
from tierlake.functions.files import basename, monthly_file_name, monthly_folder, monthly_url
from tierlake.functions.keys import TRIP_KEY_COLUMNS, surrogate_key, trip_id
from tierlake.functions.time import ntz_literal

__all__ = [
    "TRIP_KEY_COLUMNS",
    "basename",
    "day_parts",
    "monthly_file_name",
    "monthly_folder",
    "monthly_url",
    "ntz_literal",
    "surrogate_key",
    "trip_id",
    "zero_padded_month",
]
