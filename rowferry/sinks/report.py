"""Shapes for people and log stores: rendered rows, an HTML table, log events, console previews."""

from __future__ import annotations

from html import escape as escape_html

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowferry.functions.text import render_cell


def render_rows(df: DataFrame, limit: int = 100, truncate: int = 100, escape: bool = True) -> DataFrame:
    """At most `limit` rows with every cell as report text."""
    cells = [render_cell(f.name, f.dataType, truncate, escape).alias(f.name) for f in df.schema.fields]
    return df.limit(limit).select(*cells)


def html_table(df: DataFrame, limit: int = 100, truncate: int = 100) -> str:
    """The rendered rows, at most `limit` of them, as one HTML table."""
    head = "".join(f"<th>{escape_html(c)}</th>" for c in df.columns)
    body = "".join(
        "<tr>" + "".join(f"<td>{cell}</td>" for cell in row) + "</tr>"
        for row in render_rows(df, limit, truncate).collect()
    )
    return f"<table><tr>{head}</tr>{body}</table>"


def log_events(
    df: DataFrame, timestamp_column: str | None = None, timestamp_format: str | None = None
) -> DataFrame:
    """`timestamp` in epoch milliseconds and the whole row as JSON in `message`.

    The event time comes from a column, parsed by a pattern when it is text, else it is the time of the query.
    """
    if not timestamp_column:
        at = F.current_timestamp()
    elif timestamp_format:
        at = F.to_timestamp(F.col(timestamp_column), timestamp_format)
    else:
        at = F.col(timestamp_column).cast("timestamp")
    return df.select(F.unix_millis(at).alias("timestamp"), F.to_json(F.struct("*")).alias("message"))


def show_preview(df: DataFrame, numrows: int = 20, truncate: bool = True) -> None:
    df.show(n=numrows, truncate=truncate)
