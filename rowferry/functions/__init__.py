"""SQL functions available to every job, and their Column forms."""

from rowferry.functions.ids import (
    binary_to_juuid,
    binary_to_uuid,
    register_functions,
    time_uuid,
    uuid_to_binary,
    validate_uuid,
)
from rowferry.functions.text import array_to_text, compact_date, epoch_to_timestamp, render_cell

__all__ = [
    "array_to_text",
    "binary_to_juuid",
    "binary_to_uuid",
    "compact_date",
    "epoch_to_timestamp",
    "register_functions",
    "render_cell",
    "time_uuid",
    "uuid_to_binary",
    "validate_uuid",
]
