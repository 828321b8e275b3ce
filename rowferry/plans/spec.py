"""Job specifications: one JSON document that names jobs, each with sources, at most one SQL text and a destination."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator, Mapping
from dataclasses import dataclass, field

from pyspark.sql import SparkSession

from rowferry.plans.templates import expand_inline
from rowferry.sinks import PLATFORMS as SINK_PLATFORMS
from rowferry.sources import PLATFORMS as SOURCE_PLATFORMS
from rowferry.sources import input_file, read_text_file
from rowferry.sources.jdbc import is_true

Endpoint = Mapping[str, object]

# Settings never shown in reports or history, by name without `_`, `-` and `.` or by a part of it.
SECRET_KEYS = ("user", "username", "uri", "sfuser", "pem")
SECRET_PARTS = (
    "password",
    "passwd",
    "passphrase",
    "pass",
    "pwd",
    "secret",
    "token",
    "credential",
    "login",
    "jaas",
    "pemfile",
    "pemprivate",
    "privatekey",
    "accesskey",
    "apikey",
    "authuser",
    "authuid",
)
_IN_URL = re.compile(r"(://)[^/\s:@]+:[^/\s@]+@")
_IN_TEXT = re.compile(r"((?:password|passwd|pwd|secret|token|user(?:name)?|accesskey)\s*=\s*)(\"[^\"]*\"|'[^']*'|[^\s;&,\"']+)", re.I)
DEFAULT_FAILURE_THRESHOLD = 10000
# settings that a specification passes on to the one it points at
INHERITED = (
    "precisecounts",
    "inputcounts",
    "verifymigration",
    "migration_failure_threshold",
    "minexecutiontime",
    "maxexecutiontime",
)


# what an entry of `intervaljoins` has to name
INTERVAL_JOIN = ("alias", "left", "right", "leftkeys", "rightkeys", "lefttime", "righttime", "within")

# and what a `watermark` has to
WATERMARK = ("path", "name", "start", "column")


class SpecError(ValueError):
    """A specification that cannot be run as written."""


@dataclass(frozen=True)
class JobSpec:
    sources: tuple[Endpoint, ...]
    destination: Endpoint
    sql: Mapping[str, object] | None = None
    properties: Mapping[str, object] = field(default_factory=dict)
    interval_joins: tuple[Mapping[str, object], ...] = ()
    watermark: Mapping[str, object] | None = None


@dataclass(frozen=True)
class RunSpec:
    """All jobs of a document with the settings they share. Jobs are parsed one by one when they are run."""

    jobs: tuple[Mapping[str, object], ...]
    parallel: bool = False
    failure_threshold: int = DEFAULT_FAILURE_THRESHOLD
    precise_counts: bool = False
    verify: bool = False
    count_inputs: bool = False
    min_execution_time: float | None = None
    max_execution_time: float | None = None


def parse_job(document: Mapping[str, object]) -> JobSpec:
    """One job. `source` and `sources` add up; several sources or a SQL text ask for aliases."""
    sources = [*document.get("sources", [])]
    if "source" in document:
        sources.append(document["source"])
    destination = document.get("destination")
    if not sources:
        raise SpecError("a job needs a source")
    if not destination:
        raise SpecError("a job needs a destination")
    for endpoint, known in [*((s, SOURCE_PLATFORMS) for s in sources), (destination, SINK_PLATFORMS)]:
        if endpoint.get("platform") not in known:
            raise SpecError(f"unknown platform {endpoint.get('platform')!r}; known: {', '.join(known)}")
    sql = document.get("sql")
    if sql is not None and not (sql.get("query") or sql.get("inputfile")):
        raise SpecError("sql needs a query or an inputfile")
    if sql is None and len(sources) > 1:
        raise SpecError("several sources need a sql query that combines them")
    if sql is not None:
        aliases = [s.get("alias") for s in sources]
        if not all(aliases) or len(set(aliases)) < len(aliases):
            raise SpecError("with sql every source needs an alias of its own")
    joins = tuple(document.get("intervaljoins") or ())
    for join in joins:
        lacking = [k for k in INTERVAL_JOIN if not join.get(k)]
        if lacking or sql is None:
            raise SpecError(f"an interval join needs {', '.join(lacking) or 'a sql query that reads it'}")
    watermark = document.get("watermark")
    if watermark is not None:
        lacking = [k for k in WATERMARK if not watermark.get(k)]
        if lacking:
            raise SpecError(f"a watermark needs {', '.join(lacking)}")
        if len(sources) > 1 and watermark.get("source") not in [s.get("alias") for s in sources]:
            raise SpecError("a watermark needs the alias of one of several sources as its source")
    return JobSpec(tuple(sources), destination, sql, document.get("properties", {}), joins, watermark)


def load_document(spark: SparkSession, given: str | Mapping[str, object]) -> dict[str, object]:
    """A specification from a mapping, a JSON text or a path, following `jsoninputfile` pointers."""
    if isinstance(given, Mapping):
        document = dict(given)
    else:
        document = json.loads(given if given.lstrip().startswith("{") else read_text_file(spark, given))
    visited: list[str] = []
    while "jsoninputfile" in document:
        pointer = expand_inline(spark, document["jsoninputfile"])
        target = pointer.get("s3path") or pointer["path"]
        if target in visited:
            raise SpecError(f"specifications point at each other: {' -> '.join([*visited, target])}")
        visited.append(target)
        inherited = {k: document[k] for k in INHERITED if k in document}
        document = {**inherited, **json.loads(input_file(spark, pointer))}
    return document


def parse_run(document: Mapping[str, object]) -> RunSpec:
    """All jobs of a document. Without `migrations` the document is itself the one job."""
    jobs = document.get("migrations")
    if jobs is None:
        jobs = [document]
    if not jobs:
        raise SpecError("a run needs at least one job")
    limits = [float(document[k]) if document.get(k) else None for k in ("minexecutiontime", "maxexecutiontime")]
    return RunSpec(
        jobs=tuple(jobs),
        parallel=is_true(document.get("parallelmigrations", False)),
        failure_threshold=int(document.get("migration_failure_threshold", DEFAULT_FAILURE_THRESHOLD)),
        precise_counts=is_true(document.get("precisecounts", False)),
        verify=is_true(document.get("verifymigration", False)),
        count_inputs=is_true(document.get("inputcounts", False)),
        min_execution_time=limits[0],
        max_execution_time=limits[1],
    )


def is_secret(name: str) -> bool:
    plain = re.sub(r"[^a-z0-9]", "", name.lower())
    return plain in SECRET_KEYS or any(part in plain for part in SECRET_PARTS)


def redact(value: object) -> object:
    """The same structure without credentials, also those inside URLs and option texts."""
    if isinstance(value, Mapping):
        return {k: redact(v) for k, v in value.items() if not is_secret(str(k))}
    if isinstance(value, (list, tuple)):
        return [redact(v) for v in value]
    if isinstance(value, str):
        return _IN_TEXT.sub(r"\1***", _IN_URL.sub(r"\1***@", value))
    return value


def secrets(value: object, secret: bool = False) -> Iterator[str]:
    """The texts of all credentials in a document."""
    if isinstance(value, Mapping):
        for k, v in value.items():
            yield from secrets(v, secret or is_secret(str(k)))
    elif isinstance(value, (list, tuple)):
        for v in value:
            yield from secrets(v, secret)
    elif secret and value not in (None, ""):
        yield str(value)


def masked(text: str, document: Mapping[str, object]) -> str:
    """An error text without the credentials of its document."""
    for secret in sorted(set(secrets(document)), key=len, reverse=True):
        if len(secret) > 3:
            text = text.replace(secret, "***")
    return str(redact(text))


def describe(endpoint: Endpoint) -> str:
    """An endpoint in one line for a report: its scalar settings without credentials."""
    shown = redact(endpoint)
    return ", ".join(f"{k}={v}" for k, v in shown.items() if not isinstance(v, (Mapping, list)) and v != "")
