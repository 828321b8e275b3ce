"""Move and reshape tables and streams on Spark from declarative job specifications."""

from rowferry.plans import JobResult, JobsFailed, SpecError, move, report, run_job, run_jobs, transform
from rowferry.session import job_session, scratch_dir

__all__ = [
    "JobResult",
    "JobsFailed",
    "SpecError",
    "job_session",
    "move",
    "report",
    "run_job",
    "run_jobs",
    "scratch_dir",
    "transform",
]
