"""Table sinks and the failure log."""

from tierlake.sinks.tables import (
    BatchConflictError,
    PartitionedTable,
    failures_recorded,
    record_failure,
)

__all__ = ["BatchConflictError", "PartitionedTable", "failures_recorded", "record_failure"]
