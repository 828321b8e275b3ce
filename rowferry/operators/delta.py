"""Incremental moves: rows the destination lacks, rows that changes touch, and time windows kept in a state table."""

from __future__ import annotations

import json
import time
from collections.abc import Sequence
from datetime import datetime
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowferry.names import column_names
from rowferry.session import Files, settled

# so many groups are also named in a filter, which prunes partitions; the types whose values can be named exactly
LIST_LIMIT = 1000
LISTABLE = (T.StringType, T.IntegralType, T.DateType, T.TimestampNTZType, T.BooleanType)


def missing_rows(source: DataFrame, destination: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """Source rows whose key the destination does not hold yet.

    The destination's keys are made distinct first, which happens within each task before any shuffle, so that a
    key it repeats very often does not reach one task in full.
    """
    keys = column_names(keys)
    return source.join(destination.select(*keys).distinct(), keys, "left_anti")


def affected_rows(base: DataFrame, changes: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Base rows whose `on` columns occur among the changes."""
    on = column_names(on)
    return base.join(changes.select(*on).distinct(), on, "left_semi")


def rows_in_scope(
    base: DataFrame, changes: DataFrame, scope: str | Sequence[str], how: str = "left_semi"
) -> DataFrame:
    """Base rows in the partitions, or other coarse groups, that occur among the changes; null is a group too.

    The groups are found first and cast to the base's types; a group that a cast would change is an error, so
    that equality means the same however many groups there are. Base and groups meet in one null-safe semi join, whose
    small side has a known size; a moderate number of groups is named in a filter as well, which prunes partitions.
    With `left_anti` the other rows are given.
    """
    scope = column_names(scope)
    groups = settled(_as_in(base, changes.select(*scope).distinct()))
    lost = groups.where(F.col("__lost").isNotNull()).select("__lost").first()
    if lost:
        raise ValueError(f"{', '.join(scope)} of a change does not fit the type it has in the base: {lost[0]}")
    groups = groups.drop("__lost")
    if how == "left_semi" and len(scope) == 1 and isinstance(base.schema[scope[0]].dataType, LISTABLE):
        column = F.col(f"`{scope[0]}`")
        values = [row[0] for row in groups.take(LIST_LIMIT + 1)]
        if len(values) <= LIST_LIMIT:
            listed = column.isin([F.lit(v).cast(base.schema[scope[0]].dataType) for v in values if v is not None])
            base = base.where(listed | column.isNull() if None in values else listed)
    same = F.lit(True)
    for name in scope:
        same = same & F.col(f"b.`{name}`").eqNullSafe(F.col(f"g.`{name}`"))
    return base.alias("b").join(groups.alias("g"), same, how)


def _as_in(base: DataFrame, groups: DataFrame) -> DataFrame:
    """The groups in the base's types, and in `__lost` the text of a value that does not come back from its cast."""
    columns, lost = [], F.lit(None).cast("string")
    for name in groups.columns:
        value, wanted = F.col(f"`{name}`"), base.schema[name].dataType
        cast = value if groups.schema[name].dataType == wanted else value.try_cast(wanted)
        kept = cast.try_cast(groups.schema[name].dataType).eqNullSafe(value)
        lost = F.coalesce(lost, F.when(~kept, value.cast("string")))
        columns.append(cast.alias(name))
    return groups.select(*columns, lost.alias("__lost"))


class WindowTaken(RuntimeError):
    """Another mover has claimed the window of time and has not finished it."""


class WatermarkState:
    """The window of the last finished move, in a small append-only dataset.

    A move reads the half-open window (from, to] and records it only once its write is done, so a failed move is
    simply repeated. Movers claim a window by a file that only one of them can create, named by the window's lower end;
    the claim of a failed move is released, and that of a lost one can be taken over once it is `stale` seconds old.
    """

    SCHEMA = "name string, watermark_from timestamp_ntz, watermark_to timestamp_ntz"

    def __init__(self, spark: SparkSession, path: str, name: str, start: datetime):
        self._spark, self._path, self._name, self._start = spark, path.rstrip("/"), name, start

    def current(self) -> datetime:
        """The upper end of the last finished window, or the start."""
        if not Files(self._spark).exists(self._path):
            return self._start
        if not Files(self._spark).walk(self._path):
            return self._start
        states = self._spark.read.schema(self.SCHEMA).parquet(self._path).where(F.col("name") == self._name)
        return states.agg(F.max("watermark_to")).first()[0] or self._start

    def open(self, until: datetime) -> tuple[datetime, datetime]:
        return self.current(), until

    def _claim_path(self, window: tuple[datetime, datetime]) -> str:
        name = quote(self._name, safe="")
        return f"{self._path}/_claims/{name}/{window[0].strftime('%Y%m%dT%H%M%S.%f')}"

    def claim(self, until: datetime, stale: float | None = None) -> tuple[datetime, datetime]:
        """The window from the last finished move to `until`, as this mover's own; raises if another one has it."""
        files, window = Files(self._spark), self.open(until)
        if window[0] >= window[1]:
            raise ValueError(f"{self._name} has been moved up to {window[0]} already, which is not before {until}")
        path, text = self._claim_path(window), json.dumps({"to": str(until), "at": time.time()})
        if stale is not None and files.exists(path) and time.time() - json.loads(files.read_text(path))["at"] > stale:
            files.delete(path)
        if not files.create_text(path, text):
            raise WindowTaken(f"{self._name} from {window[0]} is being moved: {files.read_text(path)} in {path}")
        if self.current() != window[0]:
            # another mover finished in between
            files.delete(path)
            raise WindowTaken(f"{self._name} from {window[0]} has just been moved")
        return window

    def release(self, window: tuple[datetime, datetime]) -> None:
        """Give up a claimed window after a failure, for the next mover."""
        Files(self._spark).delete(self._claim_path(window))

    def select(self, df: DataFrame, column: str, window: tuple[datetime, datetime]) -> DataFrame:
        """Rows inside the window; both bounds are literals, so the filter reaches the scan."""
        lower, upper = (F.lit(str(bound)).cast(df.schema[column].dataType) for bound in window)
        return df.where((F.col(column) > lower) & (F.col(column) <= upper))

    def close(self, window: tuple[datetime, datetime]) -> None:
        row = self._spark.createDataFrame([(self._name, *window)], self.SCHEMA)
        row.write.mode("append").parquet(self._path)
