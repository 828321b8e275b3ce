"""Expressions inside a specification that are replaced by query results before a job runs."""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Mapping

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from rowferry.functions.text import render_cell
from rowferry.sources.jdbc import read_jdbc

INLINE = re.compile(r"inlineexpr\{\{(.*?)\}\}", re.DOTALL)
INLINE_JDBC = re.compile(r"inlineexprforjdbc\{\{(.*?)\}\}", re.DOTALL)
# Type names an inline JDBC expression may ask for.
COLUMN_TYPES = {"int": "int", "string": "string", "float": "float", "date": "date", "long": "bigint"}


def _map_texts(value: object, change: Callable[[str], str]) -> object:
    if isinstance(value, str):
        return change(value)
    if isinstance(value, Mapping):
        return {k: _map_texts(v, change) for k, v in value.items()}
    if isinstance(value, (list, tuple)):
        return [_map_texts(v, change) for v in value]
    return value


def first_row_text(spark: SparkSession, query: str) -> str:
    """The first row of a query with its columns joined by commas; an empty result gives an empty text."""
    df = spark.sql(query)
    cells = [render_cell(f.name, f.dataType, truncate=0, escape=False).alias(f"c{i}") for i, f in enumerate(df.schema)]
    row = df.limit(1).select(*cells).first()
    return ",".join(row) if row else ""


def expand_inline(spark: SparkSession, value: object) -> object:
    """Replace every `inlineexpr{{select …}}` in the texts of a specification."""
    return _map_texts(value, lambda text: INLINE.sub(lambda m: first_row_text(spark, m.group(1)), text))


def jdbc_value(spark: SparkSession, endpoint: Mapping[str, object], query: str, coltype: str = "int") -> str:
    """The first column of the one row a query returns on the endpoint's own database, as text of a type."""
    if coltype not in COLUMN_TYPES:
        raise ValueError(f"unknown coltype {coltype!r}; use one of {', '.join(COLUMN_TYPES)}")
    whole = {k: v for k, v in endpoint.items() if k != "primarykey"}
    df = read_jdbc(spark, whole, query)
    rows = df.select(F.col(f"`{df.columns[0]}`").cast(COLUMN_TYPES[coltype]).cast("string")).take(2)
    if len(rows) != 1:
        raise ValueError(f"an inline JDBC expression needs exactly one row: {query}")
    return rows[0][0]


def expand_inline_jdbc(spark: SparkSession, endpoint: Mapping[str, object]) -> dict[str, object]:
    """Replace every `inlineexprforjdbc{{"sql": …, "coltype": …}}` in the texts of a JDBC endpoint."""
    plain = {k: v for k, v in endpoint.items() if not (isinstance(v, str) and INLINE_JDBC.search(v))}

    def resolve(match: re.Match) -> str:
        inner = json.loads("{" + match.group(1).strip().removeprefix("{").removesuffix("}") + "}")
        return jdbc_value(spark, plain, inner["sql"], inner.get("coltype", "int"))

    return _map_texts(endpoint, lambda text: INLINE_JDBC.sub(resolve, text))
