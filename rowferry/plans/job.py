"""One job: sources become views in a session of their own, one SQL text combines them, one sink takes the result."""

from __future__ import annotations

import json
import traceback
import uuid
from collections.abc import Mapping
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from rowferry.functions import register_functions
from rowferry.operators.datasets import (
    TARGET_FILE_BYTES,
    append_copy,
    compact,
    copy_partitions,
    delete_dataset,
    drop_partitions,
    text_options,
)
from rowferry.operators.delta import WatermarkState
from rowferry.operators.keyed import compact_keyed_files, delete_keyed_files
from rowferry.operators.verify import digest_sums
from rowferry.plans.spec import JobSpec, describe, masked, parse_job
from rowferry.plans.templates import expand_inline, expand_inline_jdbc
from rowferry.session import Files, Written, discard, job_session, settled, size_shuffles
from rowferry.sinks import log_events, write_sink
from rowferry.sinks.files import SEQUENCE_CODECS
from rowferry.sources import input_file, read_source
from rowferry.sources.files import endpoint_path, file_path
from rowferry.sources.jdbc import is_true
from rowferry.streaming import interval_join, run_stream


@dataclass
class JobResult:
    job_id: str
    sources: str
    destination: str
    start: datetime
    end: datetime
    status: str
    count: int | None = None
    verified: str = "NA"
    error: str | None = None
    read: dict[str, int] | None = None
    size: int | None = None


@dataclass
class Moved:
    count: int | None = None
    verified: str = "NA"
    read: dict[str, int] | None = None
    size: int | None = None


# a half-open window of time
Window = tuple[datetime, datetime]


def now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


def read_sources(session: SparkSession, spec: JobSpec, window: Window | None = None) -> list[DataFrame]:
    """Read the sources in order and register them under their aliases; a watermark's source within its window."""
    frames = []
    for source in spec.sources:
        run_commands(session, source, "pre")
        df = read_source(session, expand_inline_jdbc(session, source))
        if window and source.get("alias") == spec.watermark.get("source", source.get("alias")):
            df = watermark_state(session, spec).select(df, str(spec.watermark["column"]), window)
        if source.get("alias"):
            df.createOrReplaceTempView(str(source["alias"]))
        frames.append(df)
    size_shuffles(session, frames)
    return frames


def watermark_state(session: SparkSession, spec: JobSpec) -> WatermarkState:
    mark = spec.watermark
    return WatermarkState(session, str(mark["path"]), str(mark["name"]), datetime.fromisoformat(str(mark["start"])))


def claimed_window(session: SparkSession, spec: JobSpec) -> Window | None:
    """The window of time that this run of the job moves, claimed against others; None for a job without watermark."""
    if not spec.watermark:
        return None
    until = spec.watermark.get("until")
    stale = spec.watermark.get("staleseconds")
    upper = datetime.fromisoformat(str(until)) if until else now()
    return watermark_state(session, spec).claim(upper, float(stale) if stale else None)


def apply_sql(session: SparkSession, spec: JobSpec, frames: list[DataFrame]) -> DataFrame:
    """The result of the SQL text, or the one source as it is."""
    if spec.sql is None:
        return frames[0]
    for join in spec.interval_joins:
        joined = interval_join(
            session.table(str(join["left"])),
            session.table(str(join["right"])),
            str(join["leftkeys"]),
            str(join["rightkeys"]),
            str(join["lefttime"]),
            str(join["righttime"]),
            str(join["within"]),
            str(join.get("type", "left")),
            float(join.get("slices", 0.125)),
            int(join.get("salts", 1)),
        )
        joined.createOrReplaceTempView(str(join["alias"]))
    query = str(input_file(session, spec.sql["inputfile"]) if spec.sql.get("inputfile") else spec.sql["query"])
    register_functions(session, query)
    return session.sql(query)


def prepared_session(spark: SparkSession, spec: JobSpec) -> SparkSession:
    """The job's session, with the functions that its commands and queries mention."""
    session = job_session(spark, spec.properties)
    register_functions(session, json.dumps([spec.sources, spec.destination], default=str))
    return session


def transform(spark: SparkSession, document: Mapping[str, object]) -> DataFrame:
    """The result of a job as a lazy frame, without a destination."""
    document = {"destination": {"platform": "console"}, **expand_inline(spark, document)}
    spec = parse_job(document)
    session = prepared_session(spark, spec)
    return apply_sql(session, spec, read_sources(session, spec))


def _write(df: DataFrame, destination: Mapping[str, object], count: bool, check: bool) -> dict[str, object]:
    """Write, and count the written rows and add up their digests in the same pass, so that nothing is computed twice.

    A sink that may read its rows in part, several times or not at all gets them settled first.
    """
    if not (count or check):
        write_sink(df, destination)
        return {}
    whole = destination["platform"] != "console" and str(destination.get("savemode", "")).lower() != "ignore"
    wanted = digest_sums(df.schema) if check else [F.count(F.lit(1)).alias("rows")]
    observed = Observation()
    seen = df.observe(observed, *wanted)
    if whole and not is_true(destination.get("documentfromjsonfield", False)):
        write_sink(seen, destination)
    else:
        stored = settled(seen)
        write_sink(stored, destination)
        discard(stored)
    return observed.get


def as_written(stored: DataFrame, written: DataFrame) -> DataFrame:
    """What was read back, in the columns and types that were written; folders keep partition values as text."""
    return stored.select(*[F.col(f"`{f.name}`").cast(f.dataType) for f in written.schema])


def files_before(session: SparkSession, destination: Mapping[str, object]) -> DataFrame | None:
    """The files that a file destination holds already, so that an append can be told from what was there."""
    appends = str(destination.get("savemode", "append")).lower() == "append"
    if destination["platform"] not in ("filesystem", "s3") or not appends or destination.get("fileformat") in SEQUENCE_CODECS:
        return None
    files = Files(session)
    path = endpoint_path(session, destination)
    if not files.exists(path) or not files.children(path):
        return None
    listed = session.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    # named as the rows that are read back name their files
    return settled(listed.select(F.col("_metadata.file_path").alias("path")))


def read_back(session: SparkSession, destination: Mapping[str, object], written: DataFrame) -> DataFrame | None:
    """What the destination holds, in the columns and types that were written; None where it cannot be read again."""
    platform, fileformat = destination["platform"], destination.get("fileformat")
    if platform in ("console", "kafka") or fileformat in SEQUENCE_CODECS or "rowfromjsonstring" in destination:
        return None
    if platform == "hive":
        database = destination.get("database")
        return session.table(f"{database}.{destination['table']}" if database else destination["table"]).toDF(
            *written.columns
        )
    if fileformat in ("csv", "json"):
        destination = {**destination, "schema": written.schema.toDDL()}
    return read_source(session, destination)


def move(
    spark: SparkSession,
    document: Mapping[str, object],
    count: bool = False,
    check: bool = False,
    count_inputs: bool = False,
) -> Moved:
    """Run one job and raise whatever goes wrong.

    `count` asks for the rows written, `check` for a comparison of the result with what the destination holds
    afterwards (in a file dataset that is appended to, with the files that are new), `count_inputs` for the rows of each source. Counting inputs is a job of its own per source, so that
    it does not keep filters and column pruning from reaching the scans of the move itself.
    """
    document = expand_inline(spark, document)
    spec = parse_job(document)
    session = prepared_session(spark, spec)
    window = claimed_window(session, spec)
    try:
        moved = _move(session, spec, window, count, check, count_inputs)
    except BaseException:
        if window:
            watermark_state(session, spec).release(window)
        raise
    if window:
        watermark_state(session, spec).close(window)
    return moved


def _move(
    session: SparkSession, spec: JobSpec, window: Window | None, count: bool, check: bool, count_inputs: bool
) -> Moved:
    frames = read_sources(session, spec, window)
    destination = expand_inline_jdbc(session, spec.destination)
    run_commands(session, destination, "pre")
    df = apply_sql(session, spec, frames)
    if is_true(destination.get("logevents", False)):
        df = log_events(df, destination.get("timestamp_column"), destination.get("timestamp_format"))
    moved = Moved()
    before = files_before(session, destination) if check and not df.isStreaming else None
    if df.isStreaming:
        run_stream(df, destination)
    else:
        with Written(session) as output:
            written = _write(df, destination, count, check)
        moved.size = output.bytes
        moved.count = written.get("rows") if count else None
        stored = read_back(session, destination, df) if check else None
        if stored is not None and before is not None:
            new = stored.select("*", F.col("_metadata.file_path").alias("__path"))
            stored = new.join(before, new["__path"] == before["path"], "left_anti").drop("__path")
        if stored is not None:
            found = as_written(stored, df).agg(*digest_sums(df.schema)).first().asDict()
            moved.verified = "succeeded" if found == written else "failed"
        if count_inputs:
            moved.read = {str(s.get("alias", i)): f.count() for i, (s, f) in enumerate(zip(spec.sources, frames))}
    for df in frames:
        if hasattr(df, "stored_at"):
            delete_dataset(session, df.stored_at)
    for source in spec.sources:
        run_commands(session, source, "post")
    run_commands(session, destination, "post")
    return moved


def run_job(
    spark: SparkSession,
    document: Mapping[str, object],
    precise_counts: bool = False,
    verify_job: bool = False,
    count_inputs: bool = False,
) -> JobResult:
    """Run one job; a failure ends up in the result instead of being raised."""
    start, error, moved = now(), None, Moved()
    try:
        moved = move(spark, document, precise_counts, verify_job, count_inputs)
    except Exception:
        error = masked(traceback.format_exc(), document)
    sources, destination = described(document)
    status = "Failed" if error else "Completed"
    end = now()
    return JobResult(
        uuid.uuid4().hex, sources, destination, start, end, status, moved.count, moved.verified, error, moved.read, moved.size
    )


def described(document: Mapping[str, object]) -> tuple[str, str]:
    sources = [*document.get("sources", []), *([document["source"]] if "source" in document else [])]
    return "; ".join(describe(s) for s in sources), describe(document.get("destination") or {})


def commands(endpoint: Mapping[str, object], when: str) -> list[object]:
    """The `pre` or `post` commands of an endpoint, the list first and then the single one."""
    found = list(endpoint.get(f"{when}_migrate_commands") or [])
    if endpoint.get(f"{when}_migrate_command"):
        found.append(endpoint[f"{when}_migrate_command"])
    return found


def run_commands(session: SparkSession, endpoint: Mapping[str, object], when: str) -> None:
    """Run commands in order: Spark SQL statements, or operations on datasets."""
    for command in commands(endpoint, when):
        if isinstance(command, str):
            session.sql(command)
        elif "query" in command:
            session.sql(str(command["query"]))
        else:
            _dataset_command(session, endpoint, command)


def _dataset_command(session: SparkSession, endpoint: Mapping[str, object], command: Mapping[str, object]) -> None:
    def path(name: str) -> str:
        if name in command:
            return str(command[name])
        # sources3path, destinations3path and s3path name object-store paths
        return file_path(session, str(command[name.replace("path", "s3path")]), object_store=True)

    operation = command.get("operation")
    fileformat = str(command.get("fileformat") or endpoint.get("fileformat") or "parquet").lower()
    described = {**endpoint, **command}
    delimiter = str(described.get("delimiter", "\t" if fileformat == "tsv" else ","))
    sparkoptions = {k: str(v) for k, v in (described.get("sparkoptions") or {}).items()}
    options = text_options(delimiter, str(described.get("charset", "utf-8")), sparkoptions)
    fileformat, options = ("csv", options) if fileformat in ("csv", "tsv") else (fileformat, sparkoptions)
    if operation == "copy" and is_true(command.get("partitioned", False)):
        remove = is_true(command.get("removesource", False))
        copy_partitions(session, path("sourcepath"), path("destinationpath"), fileformat, remove, options)
    elif operation == "copy":
        append_copy(session, path("sourcepath"), path("destinationpath"), fileformat, options)
    elif operation == "delete":
        delete_dataset(session, path("path"))
    elif operation == "compact":
        count, target = command.get("filecount"), int(command.get("targetbytes") or TARGET_FILE_BYTES)
        compact(session, path("path"), fileformat, int(count) if count else None, target, options)
    elif operation == "drop_partitions":
        drop_partitions(session, path("path"), list(command["partitions"]))
    elif operation == "compact_changes":
        compact_keyed_files(
            session.sql(str(command["changes"])),
            path("path"),
            fileformat,
            str(command["mappingid"]),
            str(command["scope"]),
            str(command["updatedfield"]),
            str(command["deletedwhen"]),
            is_true(command.get("dropdeletes", False)),
            [str(t) for t in command.get("orderby") or ()],
        )
    elif operation == "delete_rows":
        selection = session.sql(str(command["selection"]))
        delete_keyed_files(selection, path("path"), fileformat, str(command["mappingid"]), options)
    else:
        raise ValueError(
            f"unknown command operation {operation!r}; "
            "use copy, delete, compact, compact_changes, drop_partitions or delete_rows"
        )
