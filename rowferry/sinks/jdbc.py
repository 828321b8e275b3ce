"""JDBC sink."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from rowferry.sinks.files import check_unique_columns
from rowferry.sources.jdbc import connection


def jdbc_write_options(endpoint: Mapping[str, object]) -> dict[str, str]:
    options = {"stringtype": "unspecified"} if endpoint["platform"] == "postgres" else {}
    options.update({k: str(v) for k, v in (endpoint.get("jdbcoptions") or {}).items()})
    return {**options, **connection(endpoint), "dbtable": str(endpoint["table"])}


def write_jdbc(df: DataFrame, endpoint: Mapping[str, object]) -> None:
    """Append by default. Teradata takes one connection at a time, which `numPartitions` in jdbcoptions lifts."""
    check_unique_columns(df)
    options = jdbc_write_options(endpoint)
    if endpoint["platform"] == "teradata":
        options.setdefault("numPartitions", "1")
    mode = str(endpoint.get("savemode", "append")).lower()
    df.write.format(endpoint.get("format", "jdbc")).options(**options).mode(mode).save()
