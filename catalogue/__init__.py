"""Queries over the driver's tables, one per operator, each with the SQL that gives the same rows where there is one."""

from __future__ import annotations

from catalogue import (
    changes,
    documents,
    functions,
    jobs,
    keyed,
    messages,
    relational,
    sinks,
    sources,
    streams,
    verification,
)
from catalogue.registry import ORACLES, QUERIES

MODULES = (sources, sinks, relational, functions, jobs, keyed, changes, documents, messages, streams, verification)

__all__ = ["MODULES", "ORACLES", "QUERIES"]
