"""Run history as tables: rows per job and run, the latest status, alerts on run times, and the report."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowferry.operators.changes import latest_per_key

JOB_SCHEMA = (
    "MigrationId string, JobId string, SourceDestinationMappings string, StartTime timestamp_ntz, "
    "EndTime timestamp_ntz, ElapsedTimeInMinutes bigint, Count bigint, Size bigint, Status string"
)
RUN_SCHEMA = (
    "JobId string, MigrationJSON string, SubmissionTime timestamp_ntz, EndTime timestamp_ntz, "
    "ElapsedTimeInMinutes bigint, Status string, Errors string"
)
STATUSES = ("Started", "Completed", "Failed")


def elapsed_minutes(start: datetime, end: datetime | None, status: str) -> int:
    """Whole minutes, at least one for anything that has ended."""
    minutes = int((end - start).total_seconds() // 60) if end else 0
    return minutes if status == "Started" else max(1, minutes)


def append_history(spark: SparkSession, path: str, rows: Iterable[tuple], schema: str) -> None:
    """Add a few history rows to their table."""
    spark.createDataFrame(list(rows), schema).coalesce(1).write.mode("append").parquet(path)


def latest_status(history: DataFrame) -> DataFrame:
    """The most recent row of every job; a finished state wins over the start at the same instant."""
    finished = F.when(F.col("Status") == "Started", 0).otherwise(1)
    order = [F.desc(F.coalesce("EndTime", "StartTime")), F.desc(finished), F.desc("JobId")]
    return latest_per_key(history, "MigrationId", order)


def time_alerts(
    history: DataFrame, limits: DataFrame, key: str = "MigrationId", elapsed: str = "ElapsedTimeInMinutes"
) -> DataFrame:
    """Finished jobs that ran shorter than `minexecutiontime` or longer than `maxexecutiontime`.

    `limits` has one row per job.
    """
    ran = history.where(F.col("Status") != "Started").join(limits, key)
    outside = (F.col(elapsed) < F.col("minexecutiontime")) | (F.col(elapsed) > F.col("maxexecutiontime"))
    reason = F.when(F.col(elapsed) < F.col("minexecutiontime"), "shorter").otherwise("longer")
    return ran.where(outside).withColumn("alert", reason)
