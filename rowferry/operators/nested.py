"""Assembly of nested documents, from the innermost level outwards."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def collect_distinct(df: DataFrame, keys: Sequence[str], value: str, name: str | None = None) -> DataFrame:
    """The sorted distinct values of a column per key.

    Values are made distinct over (key, value) first: that spreads a large key over many tasks and leaves only
    what the array will hold for the second step.
    """
    distinct = df.where(F.col(value).isNotNull()).select(*keys, value).distinct()
    return distinct.groupBy(*keys).agg(F.sort_array(F.collect_list(value)).alias(name or value))


def nest(
    parent: DataFrame,
    child: DataFrame,
    on: tuple[str, str],
    fields: Mapping[str, str] | str,
    name: str,
) -> DataFrame:
    """The parent with an array of its distinct children.

    `on` is (parent column, child column). `fields` is one child column for an array of values, or a mapping from
    field name to child column for an array of documents. A parent without children gets an empty array.
    """
    parent_key, child_key = on
    if isinstance(fields, str):
        item = F.col(f"`{fields}`")
    else:
        item = F.struct(*[F.col(f"`{column}`").alias(field) for field, column in fields.items()])
    children = child.select(F.col(f"`{child_key}`").alias("__key"), item.alias("__item"))
    arrays = collect_distinct(children.where(F.col("__key").isNotNull()), ["__key"], "__item", name)
    joined = parent.join(arrays, F.col(f"`{parent_key}`") == F.col("__key"), "left")
    filled = F.coalesce(F.col(f"`{name}`"), F.array().cast(arrays.schema[name].dataType))
    return joined.select(*[F.col(f"`{c}`") for c in parent.columns], filled.alias(name))
