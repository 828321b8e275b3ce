"""File sources: CSV, JSON, Parquet, ORC, Avro, text or any other format Spark knows by name."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from rowferry.session import Files


def file_options(
    fileformat: str,
    delimiter: str = ",",
    charset: str = "utf-8",
    mergeschema: bool = False,
    sparkoptions: Mapping[str, str] | None = None,
) -> dict[str, str]:
    """Reader defaults per format; the user's options win."""
    options: dict[str, str] = {}
    if fileformat == "csv":
        options = {"header": "true", "mode": "DROPMALFORMED", "delimiter": delimiter, "charset": charset}
    elif fileformat == "parquet":
        options = {"mergeSchema": str(mergeschema).lower()}
    return {**options, **(sparkoptions or {})}


def file_path(spark: SparkSession, path: str, fileprefix: str | None = None, object_store: bool = False) -> str:
    """The path with its scheme; object-store paths default to `s3a://` locally and `s3://` on a cluster."""
    if fileprefix is None and object_store:
        fileprefix = "s3a://" if spark.sparkContext.master.startswith("local") else "s3://"
    return f"{fileprefix or ''}{path}"


def endpoint_path(spark: SparkSession, endpoint: Mapping[str, object]) -> str:
    """The full path of a file endpoint. A store with an endpoint of its own is reached by `s3a://`."""
    object_store = endpoint["platform"] == "s3"
    prefix = endpoint.get("fileprefix") or ("s3a://" if endpoint.get("s3_service_endpoint") else None)
    return file_path(spark, str(endpoint["s3path" if object_store else "path"]), prefix, object_store)


def read_files(
    spark: SparkSession,
    path: str,
    fileformat: str,
    schema: str | None = None,
    **options,
) -> DataFrame:
    """Scan files. Without a DDL `schema` CSV columns are strings and the other formats infer their schema."""
    reader = spark.read.format(fileformat).options(**file_options(fileformat, **options))
    if schema:
        reader = reader.schema(schema)
    return reader.load(path)


def stream_files(
    spark: SparkSession, path: str, fileformat: str, schema: str | None = None, **options
) -> DataFrame:
    """Follow a folder of files. The schema is the given DDL or that of a batch read of the same path."""
    resolved = schema or read_files(spark, path, fileformat, **options).schema
    reader = spark.readStream.format(fileformat).schema(resolved).options(**file_options(fileformat, **options))
    if Files(spark).is_file(path):
        # a stream follows a folder, so a single file becomes its folder with a name filter
        folder, slash, name = path.rpartition("/")
        name = re.sub(r"([\[\]{}*?\\])", r"\\\1", name)  # taken as it is, not as a pattern
        return reader.option("pathGlobFilter", name).load(folder + slash or ".")
    return reader.load(path)


def read_text_file(spark: SparkSession, path: str) -> str:
    """The whole content of one small file, such as a SQL text or a job specification."""
    return spark.read.text(path, wholetext=True).first()[0]
