"""Relational building blocks of the pipeline."""

from tierlake.operators.audit import stamp_audit
from tierlake.operators.conform import SchemaMismatch, checked_cast, conform
from tierlake.operators.latest import keep_latest, latest_per_key
from tierlake.operators.merge import (
    MergeCardinalityError,
    MergeResult,
    merge_plan,
    merge_upsert,
    replace_keys,
)
from tierlake.operators.quality import quality_report

__all__ = [
    "MergeCardinalityError",
    "MergeResult",
    "SchemaMismatch",
    "checked_cast",
    "conform",
    "keep_latest",
    "latest_per_key",
    "merge_plan",
    "merge_upsert",
    "quality_report",
    "replace_keys",
    "stamp_audit",
]
