"""Operators on DataFrames; all of them can be used without a job specification."""

from rowferry.operators.changes import compact_changes, latest_per_key
from rowferry.operators.datasets import (
    append_copy,
    compact,
    copy_partitions,
    delete_dataset,
    drop_partitions,
    partition_columns,
    read_partitioned,
    replace_partitions,
    rewrite_dataset,
)
from rowferry.operators.delta import WatermarkState, affected_rows, missing_rows, rows_in_scope
from rowferry.operators.history import latest_status, time_alerts
from rowferry.operators.joins import join_prefixed, prefixed
from rowferry.operators.keyed import delete_rows, keyed_write, unique_by_key, write_documents
from rowferry.operators.nested import collect_distinct, nest
from rowferry.operators.verify import compare_by_key, verify

__all__ = [
    "WatermarkState",
    "affected_rows",
    "append_copy",
    "collect_distinct",
    "compact",
    "compact_changes",
    "compare_by_key",
    "copy_partitions",
    "delete_dataset",
    "delete_rows",
    "drop_partitions",
    "join_prefixed",
    "keyed_write",
    "latest_per_key",
    "latest_status",
    "missing_rows",
    "nest",
    "partition_columns",
    "prefixed",
    "read_partitioned",
    "replace_partitions",
    "rewrite_dataset",
    "rows_in_scope",
    "time_alerts",
    "unique_by_key",
    "verify",
    "write_documents",
]
