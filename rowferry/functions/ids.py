"""UUID functions as built-in SQL expressions, so they stay inside whole-stage codegen.

Each one is written once as SQL over `$x`. The Column form takes a column name or SQL expression; the SQL form
is registered under the name that job specifications use.
"""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

NIL_UUID = "00000000-0000-0000-0000-000000000000"

_CANONICAL = r"r'\A[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}\z'"
_SHORT_GROUPS = r"r'\A[0-9a-fA-F]{1,8}(-[0-9a-fA-F]{1,4}){3}-[0-9a-fA-F]{1,12}\z'"


def _dashed(hex_text: str) -> str:
    parts = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
    return "lower(concat_ws('-', " + ", ".join(f"substr({hex_text}, {at}, {n})" for at, n in parts) + "))"


def _padded(x: str) -> str:
    widths = [8, 4, 4, 4, 12]
    return "concat(" + ", ".join(f"lpad(split_part($x, '-', {i}), {n}, '0')" for i, n in enumerate(widths, 1)) + ")"


def _byte_order(hex_text: str, groups: list[list[int]]) -> str:
    texts = ["concat(" + ", ".join(f"substr({hex_text}, {2 * b + 1}, 2)" for b in group) + ")" for group in groups]
    return "lower(concat_ws('-', " + ", ".join(texts) + "))"


_LEGACY_HEX = "hex(unbase64(cast($x as string)))"
# Byte positions of the legacy Java layout, group by group.
_LEGACY_ORDER = [[7, 6, 5, 4], [3, 2], [1, 0], [15, 14], [13, 12, 11, 10, 9, 8]]

VALIDATE_UUID = f"coalesce($x rlike {_CANONICAL} and $x <> '{NIL_UUID}', false)"
UUID_TO_BINARY = (
    "case when $x is null then null "
    f"when $x rlike {_SHORT_GROUPS} then unhex({_padded('$x')}) "
    "else cast(raise_error(concat('Invalid UUID string: ', $x)) as binary) end"
)
BINARY_TO_UUID = (
    "case when $x is null then null "
    f"when length($x) >= 16 then {_dashed('hex($x)')} "
    "else cast(raise_error(concat('A UUID needs 16 bytes, got ', length($x))) as string) end"
)
BINARY_TO_JUUID = (
    "case when $x is null then null "
    f"when length(unbase64(cast($x as string))) >= 16 then {_byte_order(_LEGACY_HEX, _LEGACY_ORDER)} "
    "else cast(raise_error('A legacy UUID needs the base64 text of 16 bytes') as string) end"
)

# Version 1 layout. The row number advances the 100 ns clock, so that the ids of one call in one task differ; the 14 bits
# of the clock sequence and 40 of the node (its multicast bit is set) are random per id, which keeps apart tasks, calls
# and runs that share a tick.
# Fixed value: 122192928000000000 = 100 ns ticks from 1582-10-15 to 1970-01-01.
_TICKS = (
    "lpad(hex(unix_micros(current_timestamp()) * 10 + 122192928000000000 "
    "+ (monotonically_increasing_id() & 8589934591)), 16, '0')"
)
TIME_UUID = (
    f"lower(concat_ws('-', substr({_TICKS}, 9, 8), substr({_TICKS}, 5, 4), concat('1', substr({_TICKS}, 2, 3)), "
    "hex(32768 + cast(rand() * 16384 as int)), "
    "concat('01', lpad(hex(cast(rand() * 1099511627776 as bigint)), 10, '0'))))"
)


def _over(template: str, x: str) -> Column:
    return F.expr(template.replace("$x", f"({x})"))


def validate_uuid(x: str) -> Column:
    """True only for canonical text (any case) other than the all-zero UUID; null gives false."""
    return _over(VALIDATE_UUID, x)


def uuid_to_binary(x: str) -> Column:
    """16 big-endian bytes; short groups are zero-padded, other malformed text raises."""
    return _over(UUID_TO_BINARY, x)


def binary_to_uuid(x: str) -> Column:
    """Canonical lower-case text of the first 16 bytes."""
    return _over(BINARY_TO_UUID, x)


def binary_to_juuid(x: str) -> Column:
    """Canonical text of a base64-encoded UUID in legacy Java byte order."""
    return _over(BINARY_TO_JUUID, x)


def time_uuid() -> Column:
    """A version 1 UUID per row. Not deterministic: write the frame before joining or counting on it."""
    return F.expr(TIME_UUID)


_SQL_NAMES = {
    "validateUUID(x string)": ("boolean", VALIDATE_UUID),
    "uuidToBinary(x string)": ("binary", UUID_TO_BINARY),
    "binaryToUUID(x binary)": ("string", BINARY_TO_UUID),
    "binaryToJUUID(x binary)": ("string", BINARY_TO_JUUID),
    "timeUUID()": ("string", TIME_UUID),
}


def register_functions(spark: SparkSession, text: str | None = None) -> None:
    """Make the functions callable from SQL in this session (temporary functions are session-local).

    With a `text` only those it mentions are registered.
    """
    for signature, (returns, body) in _SQL_NAMES.items():
        if text is None or signature.split("(")[0].lower() in text.lower():
            body = body.replace("$x", "x")
            spark.sql(f"create or replace temporary function {signature} returns {returns} return {body}")
