"""All jobs of a specification, one after the other or side by side, with history, alerts and a report."""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime
from threading import Lock

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

from rowferry.operators.history import JOB_SCHEMA, RUN_SCHEMA, append_history, elapsed_minutes
from rowferry.plans.job import JobResult, described, now, run_job
from rowferry.plans.spec import RunSpec, load_document, parse_run, redact
from rowferry.plans.templates import expand_inline

# jobs side by side on one cluster; each has a scheduler pool of its own
MAX_PARALLEL_JOBS = 32
REPORT_SCHEMA = (
    "job_id string, sources string, destination string, start_time timestamp_ntz, end_time timestamp_ntz, "
    "status string, count bigint, verification string, error string"
)
ALERT_SCHEMA = (
    "JobId string, elapsedtime double, minexecutiontime double, maxexecutiontime double, status string, "
    "InstantNow timestamp_ntz, processedflag bigint"
)


class JobsFailed(RuntimeError):
    """Raised once at the end of a run; `results` holds the outcome of every job."""

    def __init__(self, results: Sequence[JobResult]):
        self.results = list(results)
        super().__init__("\n".join(r.error for r in results if r.error))


def run_jobs(
    spark: SparkSession,
    given: str | Mapping[str, object],
    history_path: str | None = None,
    raise_errors: bool = True,
) -> list[JobResult]:
    """Run a specification given as a mapping, a JSON text or a path.

    Serial runs stop once as many jobs have failed as `migration_failure_threshold` says; the rest are reported
    as SKIPPED. With `history_path` rows about the run, its jobs and its run time are appended below that path.
    """
    document = expand_inline(spark, load_document(spark, given))
    run = parse_run(document)
    run_id, start = uuid.uuid4().hex, now()
    history = _History(spark, history_path, run_id, run, document, start)
    history.started()
    results = (_parallel if run.parallel else _serial)(spark, run, history)
    history.ended(results)
    if raise_errors and any(r.status == "Failed" for r in results):
        raise JobsFailed(results)
    return results


def _run(spark: SparkSession, run: RunSpec, history: _History, number: int, job: Mapping[str, object]) -> JobResult:
    history.job_started(number, job)
    result = run_job(spark, job, run.precise_counts, run.verify, run.count_inputs)
    history.job_ended(number, result)
    return result


def _serial(spark: SparkSession, run: RunSpec, history: _History) -> list[JobResult]:
    results: list[JobResult] = []
    for number, job in enumerate(run.jobs):
        failures = sum(r.status == "Failed" for r in results)
        if failures and failures >= run.failure_threshold:
            at = now()
            results.append(JobResult(uuid.uuid4().hex, *described(job), at, at, "SKIPPED"))
            history.job_ended(number, results[-1])
        else:
            results.append(_run(spark, run, history, number, job))
    return results


def _parallel(spark: SparkSession, run: RunSpec, history: _History) -> list[JobResult]:
    context = spark.sparkContext

    @inheritable_thread_target(spark)
    def in_own_pool(numbered: tuple[int, Mapping[str, object]]) -> JobResult:
        number, job = numbered
        context.setLocalProperty("spark.scheduler.pool", f"job-{number}")
        try:
            return _run(spark, run, history, number, job)
        finally:
            context.setLocalProperty("spark.scheduler.pool", None)

    with ThreadPoolExecutor(min(MAX_PARALLEL_JOBS, len(run.jobs))) as threads:
        return list(threads.map(in_own_pool, enumerate(run.jobs)))


class _History:
    """History rows of one run; does nothing without a path."""

    def __init__(
        self,
        spark: SparkSession,
        path: str | None,
        run_id: str,
        run: RunSpec,
        document: Mapping[str, object],
        start: datetime,
    ):
        self._spark, self._path, self._run_id, self._run = spark, path, run_id, run
        self._text, self._start = json.dumps(redact(document)), start
        self._lock = Lock()

    def started(self) -> None:
        if self._path:
            self._append_run("Started", None, None)

    def job_started(self, number: int, job: Mapping[str, object]) -> None:
        """A row when a job starts, so that a lost driver leaves a trace of it."""
        self._append_job(number, *described(job), now(), None, None, None, "Started")

    def job_ended(self, number: int, r: JobResult) -> None:
        self._append_job(number, r.sources, r.destination, r.start, r.end, r.count, r.size, r.status)

    def _append_job(self, number: int, sources: str, destination: str, start, end, count, size, status: str) -> None:
        if not self._path:
            return
        mapping = json.dumps({"sources": sources, "destination": destination})
        minutes = elapsed_minutes(start, end, status)
        row = (str(number), self._run_id, mapping, start, end, minutes, count, size, status)
        with self._lock:  # appends to one folder must not overlap
            append_history(self._spark, f"{self._path}/jobs", [row], JOB_SCHEMA)

    def ended(self, results: Sequence[JobResult]) -> None:
        if not self._path:
            return
        errors = [r.error for r in results if r.error]
        status = "Failed" if errors else "Completed"
        self._append_run(status, now(), "\n".join(errors) or None)
        self._append_alert(status)

    def _append_run(self, status: str, end: datetime | None, errors: str | None) -> None:
        minutes = elapsed_minutes(self._start, end, status)
        row = (self._run_id, self._text, self._start, end, minutes, status, errors)
        append_history(self._spark, f"{self._path}/runs", [row], RUN_SCHEMA)

    def _append_alert(self, status: str) -> None:
        low, high = self._run.min_execution_time, self._run.max_execution_time
        if low is None or high is None:
            return
        seconds = (now() - self._start).total_seconds()
        row = (self._run_id, seconds, low, high, status, now(), 0)
        append_history(self._spark, f"{self._path}/alerts", [row], ALERT_SCHEMA)


def report(spark: SparkSession, results: Sequence[JobResult]) -> DataFrame:
    """One row per job: where from and to, when, the count or error, and the verification."""
    rows = [
        (r.job_id, r.sources, r.destination, r.start, r.end, r.status, r.count, r.verified, r.error) for r in results
    ]
    return spark.createDataFrame(rows, REPORT_SCHEMA)
