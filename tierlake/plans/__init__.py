"""Layer transforms and the pipeline that chains them."""

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
from tierlake.plans.lakehouse import Lakehouse, stage

__all__ = [
    "Lakehouse",
    "bronze_batch",
    "bronze_rows",
    "gold_batch",
    "gold_daily_revenue",
    "gold_trip_revenue",
    "silver_batch",
    "silver_project",
    "silver_transform",
    "stage",
    "top_rows",
]
