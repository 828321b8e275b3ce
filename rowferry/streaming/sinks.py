"""Stream sinks of a job and the wait for their end."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from rowferry.names import column_names
from rowferry.sinks.files import FORMATS
from rowferry.sinks.messages import encode_for, producer_options
from rowferry.sources.files import endpoint_path


def _triggered(writer: DataStreamWriter, endpoint: Mapping[str, object]) -> DataStreamWriter:
    """`available_now` takes what is there and ends; otherwise micro-batches go on, at an interval if given."""
    trigger = endpoint.get("trigger")
    if trigger == "available_now":
        return writer.trigger(availableNow=True)
    if trigger == "processing_time":
        return writer.trigger(processingTime=str(endpoint.get("triggerinterval", "0 seconds")))
    if trigger:
        raise ValueError(f"unknown trigger {trigger!r}; use available_now or processing_time")
    return writer


def start_stream(df: DataFrame, endpoint: Mapping[str, object]) -> StreamingQuery:
    """Start the query that an endpoint describes: files, console or Kafka."""
    platform = endpoint["platform"]
    user_options = {k: str(v) for k, v in (endpoint.get("sparkoptions") or {}).items()}
    if platform in ("filesystem", "s3"):
        fileformat = str(endpoint["fileformat"])
        if fileformat not in FORMATS:
            raise ValueError(f"unknown stream file format {fileformat!r}")
        path = endpoint_path(df.sparkSession, endpoint)
        # a restart must find the same checkpoint, and readers skip names that start with an underscore
        options = {"header": "true", "path": path, "checkpointLocation": f"{path}/_checkpoint", **user_options}
        writer = df.writeStream.format(fileformat).options(**options)
        partition_columns = column_names(endpoint.get("groupbyfields"))
        if partition_columns:
            writer = writer.partitionBy(*partition_columns)
    elif platform == "console":
        writer = df.writeStream.format("console").outputMode(str(endpoint.get("outputmode", "append")))
        writer = writer.options(
            numRows=str(endpoint.get("numrows", 20)),
            truncate=str(endpoint.get("truncate", True)).lower(),
            **user_options,
        )
    elif platform == "kafka":
        writer = encode_for(df, endpoint).writeStream.format(endpoint.get("format", "kafka"))
        writer = writer.options(**producer_options(endpoint))
    else:
        raise ValueError(f"{platform!r} cannot be a stream destination; use filesystem, s3, kafka or console")
    return _triggered(writer, endpoint).start()


def run_stream(df: DataFrame, endpoint: Mapping[str, object]) -> StreamingQuery:
    """Start a query and wait for this query alone; its failure is raised here."""
    query = start_stream(df, endpoint)
    query.awaitTermination()
    return query
