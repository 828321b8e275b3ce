"""Job specifications and their execution."""

from rowferry.plans.job import JobResult, move, run_job, transform
from rowferry.plans.runner import JobsFailed, report, run_jobs
from rowferry.plans.spec import JobSpec, RunSpec, SpecError, load_document, parse_job, parse_run, redact

__all__ = [
    "JobResult",
    "JobSpec",
    "JobsFailed",
    "RunSpec",
    "SpecError",
    "load_document",
    "move",
    "parse_job",
    "parse_run",
    "redact",
    "report",
    "run_job",
    "run_jobs",
    "transform",
]
