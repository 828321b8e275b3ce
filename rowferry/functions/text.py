"""Column builders for text that jobs and reports need."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def array_to_text(column: Column | str) -> Column:
    """`[a,b,c]`, the usual way to move an array into a store without array columns."""
    column = F.col(column) if isinstance(column, str) else column
    return F.concat(F.lit("["), F.concat_ws(",", column.cast("array<string>")), F.lit("]"))


def compact_date(column: Column | str) -> Column:
    """Partition text of a date-time string: the part before the first `:` without `-`, `:`, `T` and blanks."""
    column = F.col(column) if isinstance(column, str) else column
    return F.translate(F.substring_index(column, ":", 1), "-:T ", "")


def epoch_to_timestamp(column: Column | str) -> Column:
    """Seconds since 1970 as a timestamp, whatever the session's time zone."""
    column = F.col(column) if isinstance(column, str) else column
    return F.timestamp_seconds(column)


def render_cell(name: str, data_type: T.DataType, truncate: int = 100, escape: bool = True) -> Column:
    """One report cell: `null` for null, `[0A FF]` for bytes, `[a, b]` for arrays, cut to `truncate` characters."""
    column = F.col(f"`{name}`")
    if isinstance(data_type, T.BinaryType):
        pairs = F.regexp_replace(F.hex(column), "(..)(?=.)", "$1 ")
        text = F.concat(F.lit("["), pairs, F.lit("]"))
    elif isinstance(data_type, T.ArrayType):
        shown = F.transform(column, lambda x: F.coalesce(x.cast("string"), F.lit("null")))
        text = F.concat(F.lit("["), F.concat_ws(", ", shown), F.lit("]"))
    else:
        text = column.cast("string")
    text = F.coalesce(text, F.lit("null"))
    if truncate > 0:
        short = F.left(text, F.lit(truncate))
        if truncate >= 4:
            short = F.concat(F.left(text, F.lit(truncate - 3)), F.lit("..."))
        text = F.when(F.length(text) > truncate, short).otherwise(text)
    if escape:
        for plain, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
            text = F.replace(text, F.lit(plain), F.lit(entity))
    return text
