"""Joins of two streams within an interval of time, whose state does not gather in one task when a key is hot."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rowferry.names import column_names

# times keep their microseconds on the way through Python
MICROSECONDS = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def seconds_of(spark: SparkSession, interval: str) -> int:
    """The seconds of an interval such as `30 days`; months have no fixed length."""
    if any(word in interval.lower() for word in ("month", "year")):
        raise ValueError(f"{interval!r} has no fixed length; give it in days or smaller units")
    return spark.sql(f"SELECT unix_seconds(timestamp_seconds(0) + INTERVAL {interval})").first()[0]


def interval_join(
    left: DataFrame,
    right: DataFrame,
    left_keys: str | Sequence[str],
    right_keys: str | Sequence[str],
    left_time: str,
    right_time: str,
    within: str,
    how: str = "left",
    slices: float = 0.125,
    salts: int = 1,
) -> DataFrame:
    """Rows of the left stream with those of the right that have its key and come at most `within` after it.

    Time is cut into buckets, `slices` to the interval. A left row lies in the bucket of its time; a right row is copied
    to all buckets whose left rows it may meet. The bucket is part of the join key, so that the state of one key is dealt
    to as many tasks as it has buckets. With less than one slice a bucket spans several intervals and the state holds a
    right row 1 + `slices` times on average, with whole slices `slices` + 1 times. With `salts` left rows are dealt
    further, by a hash of the row, and right rows are copied that often. As every left row lies in one place, matches are not repeated and an outer join gives its one
    row without a match, once the watermark has passed. Both times are timestamps and should have a watermark; the streams
    have no column names in common. Static frames are joined the same way. `count` gives `interval_counts`, streams only.
    """
    if how == "count":
        return interval_counts(left, right, left_keys, right_keys, left_time, right_time, within, slices)
    if how not in ("inner", "left"):
        raise ValueError(f"an interval join is inner or left, or a count, not {how!r}")
    clash = sorted(set(left.columns) & set(right.columns))
    if clash:
        raise ValueError(f"both streams have the columns {', '.join(clash)}; rename them")
    whole = seconds_of(left.sparkSession, within)
    width = max(math.ceil(whole / slices), 1)
    second = lambda c: F.unix_seconds(F.col(f"`{c}`"))
    bucket = lambda seconds: F.floor(seconds / width)
    near = left.withColumn("__bucket", bucket(second(left_time)))
    reached = F.sequence(bucket(second(right_time) - whole), bucket(second(right_time)))
    far = right.withColumn("__at", F.explode(reached))
    same: Column = F.col("__bucket") == F.col("__at")
    if salts > 1:
        salt = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in left.columns]), F.lit(salts))
        near = near.withColumn("__salt", salt)
        far = far.withColumn("__copy", F.explode(F.array(*[F.lit(i).cast("long") for i in range(salts)])))
        same = same & (F.col("__salt") == F.col("__copy"))
    for a, b in zip(column_names(left_keys), column_names(right_keys), strict=True):
        same = same & (F.col(f"`{a}`") == F.col(f"`{b}`"))
    start, end = F.col(f"`{left_time}`"), F.col(f"`{right_time}`")
    same = same & (end >= start) & (end <= start + F.expr(f"INTERVAL {whole} SECONDS"))
    how = "left_outer" if how == "left" else how
    return near.join(far, same, how).drop("__bucket", "__salt", "__at", "__copy")


def interval_counts(
    left: DataFrame,
    right: DataFrame,
    left_keys: str | Sequence[str],
    right_keys: str | Sequence[str],
    left_time: str,
    right_time: str,
    within: str,
    slices: float = 0.125,
) -> DataFrame:
    """Rows of the left stream with `n`, how many rows of the right have their key and come at most `within` after them.

    For streams where a key is so hot that the pairs of `interval_join` would grow with the square of its rows: a bucket
    of a key holds the sorted times of its right rows, in which each left row finds its count. A left row comes again
    for matches of a later micro-batch, so its counts are to be added up; with zero it comes once, if the watermark
    passes it without a match. Both streams need a watermark. Left rows without a time are left out.
    """
    whole = seconds_of(left.sparkSession, within)
    width = max(math.ceil(whole / slices), 1)
    bucket = lambda c, back=0: F.floor((F.unix_seconds(F.col(f"`{c}`")) - back) / width)
    keys = lambda names: F.struct(*[F.col(f"`{n}`").alias(f"k{i}") for i, n in enumerate(column_names(names))])
    row = F.struct(*[F.col(f"`{c}`") for c in left.columns])
    near = left.select(
        F.col(f"`{left_time}`").alias("time"), keys(left_keys).alias("key"), bucket(left_time).alias("bucket"),
        F.to_json(row, MICROSECONDS).alias("row"),
    ).filter("time IS NOT NULL")
    reached = F.explode(F.sequence(bucket(right_time, whole), bucket(right_time)))
    far = right.select(
        F.col(f"`{right_time}`").alias("time"), keys(right_keys).alias("key"), reached.alias("bucket"),
        F.lit(None).cast("string").alias("row"),
    )
    # null keys and times meet nothing: such left rows have a group of their own, such right rows go
    known = lambda names: F.greatest(*[F.col(f"key.k{i}").isNull() for i, _ in enumerate(column_names(names))], F.lit(False))
    far = far.filter(~known(right_keys))
    both = near.unionByName(far).withColumn("at", F.unix_micros(F.col("time").cast("timestamp")))
    reach = whole * 1_000_000

    def count(_, batches, state):
        import pickle

        import numpy as np
        import pandas as pd

        rows, starts, met, times = pickle.loads(state.get[0]) if state.exists else ([], *([np.zeros(0, np.int64)] * 3))
        out_rows, out_counts = [], []
        if not state.hasTimedOut:
            parts = [(b["row"].to_numpy(object), b["at"].to_numpy()) for b in batches]
            given, at = (np.concatenate(x) for x in zip(*parts))
            is_left = np.array([r is not None for r in given], bool)
            new = np.sort(at[~is_left])
            held = np.sort(np.concatenate([times, new]))
            rows = [*rows, *given[is_left]]
            old, starts = len(starts), np.concatenate([starts, at[is_left]])
            within = lambda sorted_, t: np.searchsorted(sorted_, t + reach, "right") - np.searchsorted(sorted_, t)
            found = np.concatenate([within(new, starts[:old]), within(held, starts[old:])])
            met, times = np.concatenate([met, np.zeros(len(starts) - old, np.int64)]) + found, held
            hit = np.flatnonzero(found)
            out_rows += [rows[i] for i in hit]
            out_counts += found[hit].tolist()
        mark = state.getCurrentWatermarkMs()
        passed = starts + reach < mark * 1000
        for i in np.flatnonzero(passed & (met == 0)):
            out_rows.append(rows[i])
            out_counts.append(0)
        rows = [rows[i] for i in np.flatnonzero(~passed)]
        starts, met, times = starts[~passed], met[~passed], times[times >= mark * 1000]
        if len(rows) or len(times):
            state.update((pickle.dumps((rows, starts, met, times)),))
            last = int(starts.min() + reach if len(rows) else times.max()) // 1000 + 1
            state.setTimeoutTimestamp(max(last, mark + 1))
        else:
            state.remove()
        yield pd.DataFrame({"row": out_rows, "n": out_counts})

    counted = both.groupBy("key", "bucket").applyInPandasWithState(
        count, "row string, n long", "held binary", "append", "EventTimeTimeout"
    )
    return counted.select(F.from_json("row", left.schema, MICROSECONDS).alias("row"), "n").select("row.*", "n")
