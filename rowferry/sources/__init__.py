"""One entry point over all sources."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType

from rowferry.sources.catalog import read_catalog
from rowferry.sources.connectors import FORMATS, read_connector
from rowferry.sources.documents import (
    parse_documents,
    parse_mixed_documents,
    read_json_documents,
    stage_documents,
    to_json_documents,
)
from rowferry.sources.files import endpoint_path, file_path, read_files, read_text_file, stream_files
from rowferry.sources.jdbc import DRIVERS, is_true, read_jdbc
from rowferry.sources.messages import decode_messages, read_messages, unwrap_change_stream

PLATFORMS = ("filesystem", "s3", "hive", "kafka", *DRIVERS, *FORMATS)

__all__ = [
    "PLATFORMS",
    "decode_messages",
    "parse_documents",
    "parse_mixed_documents",
    "read_connector",
    "read_files",
    "read_jdbc",
    "read_json_documents",
    "read_messages",
    "read_source",
    "read_text_file",
    "stage_documents",
    "stream_files",
    "to_json_documents",
    "unwrap_change_stream",
]


def input_file(spark: SparkSession, pointer: Mapping[str, str]) -> str:
    """The text behind an `inputfile`-style pointer: {"path": …} or {"s3path": …}."""
    if "s3path" in pointer:
        return read_text_file(spark, file_path(spark, pointer["s3path"], object_store=True))
    return read_text_file(spark, pointer["path"])


def read_source(spark: SparkSession, endpoint: Mapping[str, object]) -> DataFrame:
    """The frame an endpoint of a job specification describes."""
    platform = endpoint.get("platform")
    streaming = is_true(endpoint.get("isstream", False))
    if platform in ("filesystem", "s3"):
        df = _read_file_endpoint(spark, endpoint, streaming)
    elif platform in DRIVERS:
        pointer = endpoint.get("querys3sqlfile")
        df = read_jdbc(spark, endpoint, input_file(spark, pointer) if pointer else None)
    elif platform == "hive":
        df = read_catalog(spark, str(endpoint["query"]), endpoint.get("properties"))
    elif platform == "kafka":
        df = read_messages(spark, endpoint, streaming)
    elif platform == "mongodb" and is_true(endpoint.get("overrideconnector", False)):
        df = stage_documents(to_json_documents(read_connector(spark, endpoint)), str(endpoint["tmpfilelocation"]))
    elif platform in FORMATS:
        df = read_connector(spark, endpoint)
    else:
        raise ValueError(f"unknown source platform {platform!r}; known: {', '.join(PLATFORMS)}")
    if df.isStreaming and endpoint.get("streamwatermarkdelay"):
        df = with_watermark(
            df, str(endpoint.get("streamwatermarkfield", "timestamp")), str(endpoint["streamwatermarkdelay"])
        )
    return df


def with_watermark(df: DataFrame, field: str, delay: str) -> DataFrame:
    """A watermark on an event-time column; one without time zone is read in the session's zone."""
    if isinstance(df.schema[field].dataType, TimestampNTZType):
        df = df.withColumn(field, F.col(field).cast("timestamp"))
    return df.withWatermark(field, delay)


def _read_file_endpoint(spark: SparkSession, endpoint: Mapping[str, object], streaming: bool) -> DataFrame:
    path = endpoint_path(spark, endpoint)
    options = {
        "delimiter": str(endpoint.get("delimiter", ",")),
        "charset": str(endpoint.get("charset", "utf-8")),
        "mergeschema": is_true(endpoint.get("mergeschema", False)),
        "sparkoptions": {k: str(v) for k, v in (endpoint.get("sparkoptions") or {}).items()},
    }
    if is_true(endpoint.get("mixedtypes", False)):
        if streaming or str(endpoint["fileformat"]) != "json":
            raise ValueError("mixedtypes reads JSON files as a batch")
        sample = endpoint.get("samplesize")
        return parse_mixed_documents(read_json_documents(spark, path), samplesize=int(sample) if sample else None)
    read = stream_files if streaming else read_files
    return read(spark, path, str(endpoint["fileformat"]), endpoint.get("schema"), **options)
