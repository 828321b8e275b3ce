"""One entry point over all batch sinks."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowferry.operators.keyed import MODES as KEYED_MODES
from rowferry.operators.keyed import write_keyed_files
from rowferry.sinks.catalog import insert_into_table
from rowferry.sinks.files import write_files, write_raw_json, write_sequence_file
from rowferry.sinks.jdbc import write_jdbc
from rowferry.sinks.messages import encode_messages, write_messages
from rowferry.sinks.report import html_table, log_events, render_rows, show_preview
from rowferry.sources.connectors import FORMATS as CONNECTORS
from rowferry.sources.connectors import write_connector
from rowferry.sources.documents import parse_documents
from rowferry.sources.files import endpoint_path
from rowferry.sources.jdbc import DRIVERS, is_true

PLATFORMS = ("filesystem", "s3", "hive", "kafka", "console", *DRIVERS, *CONNECTORS)

__all__ = [
    "PLATFORMS",
    "encode_messages",
    "html_table",
    "insert_into_table",
    "log_events",
    "render_rows",
    "write_files",
    "write_raw_json",
    "write_sequence_file",
    "write_sink",
]


def write_sink(df: DataFrame, endpoint: Mapping[str, object]) -> None:
    """Write a batch frame to the destination of a job specification."""
    platform = endpoint.get("platform")
    if platform in ("filesystem", "s3"):
        _write_file_endpoint(df, endpoint)
    elif platform in DRIVERS:
        write_jdbc(df, endpoint)
    elif platform == "hive":
        insert_into_table(
            df,
            str(endpoint["table"]),
            endpoint.get("database"),
            str(endpoint.get("savemode", "append")),
            is_true(endpoint.get("partitions", False)),
        )
    elif platform == "kafka":
        write_messages(df, endpoint)
    elif platform == "console":
        show_preview(df, int(endpoint.get("numrows", 20)), is_true(endpoint.get("truncate", True)))
    elif platform in CONNECTORS:
        if is_true(endpoint.get("documentfromjsonfield", False)):
            field = str(endpoint.get("jsonfield", "jsonfield"))
            df = parse_documents(df.select(F.col(field)), endpoint.get("documentschema"), field)
        write_connector(df, endpoint)
    else:
        raise ValueError(f"unknown destination platform {platform!r}; known: {', '.join(PLATFORMS)}")


def _write_file_endpoint(df: DataFrame, endpoint: Mapping[str, object]) -> None:
    path = endpoint_path(df.sparkSession, endpoint)
    savemode = str(endpoint.get("savemode", "append"))
    count = endpoint.get("coalescefilecount")
    if is_true(endpoint.get("rowfromjsonstring", False)):
        write_raw_json(df, path, savemode)
    elif savemode.lower() in KEYED_MODES:
        write_keyed_files(
            df,
            path,
            str(endpoint["fileformat"]),
            str(endpoint["mappingid"]),
            savemode.lower(),
            endpoint.get("groupbyfields", ""),
        )
    else:
        write_files(
            df,
            path,
            str(endpoint["fileformat"]),
            savemode,
            endpoint.get("groupbyfields"),
            int(count) if count else None,
            {k: str(v) for k, v in (endpoint.get("sparkoptions") or {}).items()},
            is_true(endpoint.get("rebalance", True)),
        )
