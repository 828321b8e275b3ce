"""Catalog source: a SQL text over tables of the metastore."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


def read_catalog(spark: SparkSession, query: str, properties: Mapping[str, object] | None = None) -> DataFrame:
    """Run a query in the job's session. Settings fixed at start-up, such as the metastore version, are left alone."""
    for key, value in (properties or {}).items():
        if spark.conf.isModifiable(key) or not key.startswith("spark.sql."):
            spark.conf.set(key, str(value))
    return spark.sql(query)
