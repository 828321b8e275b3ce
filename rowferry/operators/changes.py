"""Change data: the latest row per key and compaction of a base table with its change log."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowferry.names import column_names
from rowferry.operators.delta import rows_in_scope
from rowferry.session import settled

# Fixed value: the date a deleted row carries.
DELETED_AT = "3000-01-01 00:00:00"


def latest_per_key(df: DataFrame, keys: str | Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of every key under `order`.

    Catalyst turns the rank filter into a limit per task before the shuffle, so a key with very many rows sends
    one row per task, not all of them.
    """
    window = Window.partitionBy(*column_names(keys)).orderBy(*order)
    return df.withColumn("__rank", F.row_number().over(window)).where("__rank = 1").drop("__rank")


def compact_changes(
    base: DataFrame,
    changes: DataFrame,
    keys: str | Sequence[str],
    scope: str | Sequence[str],
    updated_at: str,
    deleted: Column,
    drop_deletes: bool = False,
    tie_break: Sequence[Column] = (),
) -> DataFrame:
    """Merge a change log into the part of a base table that it touches.

    Only base rows whose `scope` columns occur among the changes take part. Per key the latest row wins, and a
    delete wins over everything. Deleted keys stay as rows dated `DELETED_AT` unless `drop_deletes`. The log is written to
    the scratch folder first, so this runs a job.
    """
    columns = base.columns
    # once, for the groups it touches and for its rows
    changes = settled(changes)
    tombstone = F.lit(DELETED_AT).try_cast(base.schema[updated_at].dataType)
    kept = rows_in_scope(base, changes, scope).select(*columns).withColumn("__deleted", F.lit(False))
    dated = F.when(deleted, tombstone).otherwise(F.col(updated_at)).alias(updated_at)
    logged = changes.select(
        *[dated if c == updated_at else F.col(f"`{c}`") for c in columns],
        F.coalesce(deleted, F.lit(False)).alias("__deleted"),
    )
    order = [F.desc("__deleted"), F.desc(updated_at), *tie_break]
    latest = latest_per_key(kept.unionByName(logged), keys, order)
    if drop_deletes:
        latest = latest.where(~F.col("__deleted"))
    return latest.select(*columns)
