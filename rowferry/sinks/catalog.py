"""Catalog sink: insert by position into an existing table."""

from __future__ import annotations

from pyspark.sql import DataFrame

from rowferry.operators.datasets import setting


def insert_into_table(
    df: DataFrame, table: str, database: str | None = None, savemode: str = "append", partitions: bool = False
) -> None:
    """Columns match by position, partition columns last.

    With `partitions` an overwrite replaces only the partitions that occur in the frame. Rows are rebalanced by the
    table's partition columns first, so that a small partition gets one file and a large one several.
    """
    name = f"{database}.{table}" if database else table
    overwrite = savemode.lower() == "overwrite"
    mode = "dynamic" if partitions else "static"
    count = sum(column.isPartition for column in df.sparkSession.catalog.listColumns(name))
    if count:
        df = df.hint("rebalance", *df.columns[-count:])
    with setting(df.sparkSession, "spark.sql.sources.partitionOverwriteMode", mode):
        df.write.insertInto(name, overwrite=overwrite)
