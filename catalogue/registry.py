"""The registry of queries and the few helpers they share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowferry import job_session, move, scratch_dir

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function name, with its SQL counterpart. It runs in a job session."""

    def register(function: Query) -> Query:
        key = name or function.__name__
        QUERIES[key] = lambda spark, sf_dir: function(job_session(spark), sf_dir)
        if sql is not None:
            ORACLES[key] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def source(sf_dir: str, name: str, alias: str | None = None, **options) -> dict[str, object]:
    """A driver table as a source of a job."""
    endpoint = {"platform": "filesystem", "path": f"{sf_dir}/{name}.parquet", "fileformat": "parquet"}
    return {**endpoint, "alias": alias or name, **options}


def files(path: str, fileformat: str, **options) -> dict[str, object]:
    return {"platform": "filesystem", "path": path, "fileformat": fileformat, **options}


# a timestamp as text, the same in Spark and in SQL
SECONDS = "yyyy-MM-dd HH:mm:ss"


def dated(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn(column, F.date_format(F.col(column).cast("timestamp_ntz"), SECONDS))


def stage(spark: SparkSession, df: DataFrame, fileformat: str, **options: str) -> str:
    """Write a frame in some format to a fresh folder, as input of a source under test."""
    path = scratch_dir(spark, "staged")
    df.write.format(fileformat).options(**options).save(path)
    return path


def moved(spark: SparkSession, document: dict[str, object], fileformat: str = "parquet", **destination) -> str:
    """Run a job into a fresh folder and return the folder."""
    path = scratch_dir(spark, "moved")
    move(spark, {**document, "destination": files(path, fileformat, **destination)})
    return path
