"""Joins of sources that share column names."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def prefixed(df: DataFrame, alias: str) -> DataFrame:
    """All columns renamed to `alias_column`."""
    return df.select(*[F.col(f"`{c}`").alias(f"{alias}_{c}") for c in df.columns])


def join_prefixed(frames: Mapping[str, DataFrame], on: str, how: str = "inner") -> DataFrame:
    """`X.*, Y.*, Z.*` of sources joined on one shared column, with names a file sink accepts."""
    (first, joined), *others = [(alias, prefixed(df, alias)) for alias, df in frames.items()]
    for alias, df in others:
        joined = joined.join(df, F.col(f"`{first}_{on}`") == F.col(f"`{alias}_{on}`"), how)
    return joined
