"""File sinks: formats, save modes, partitioned layouts, file counts, sequence files and raw JSON."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowferry.names import column_names
from rowferry.operators.datasets import file_size
from rowferry.session import settled

FORMATS = ("json", "csv", "parquet", "orc", "avro", "text")
# Sequence file format -> Hadoop codec.
SEQUENCE_CODECS = {
    "sequencefile": "org.apache.hadoop.io.compress.DefaultCodec",
    "sequencefilesnappy": "org.apache.hadoop.io.compress.SnappyCodec",
    "sequencefiledeflate": "org.apache.hadoop.io.compress.DeflateCodec",
}
SAVE_MODES = {"append": "append", "overwrite": "overwrite", "errorifexists": "error", "ignore": "ignore"}


def check_unique_columns(df: DataFrame) -> None:
    seen: set[str] = set()
    repeated = sorted({c for c in df.columns if c.lower() in seen or seen.add(c.lower())})
    if repeated:
        raise ValueError(f"columns occur more than once: {', '.join(repeated)}; alias them or use join_prefixed")


def write_files(
    df: DataFrame,
    path: str,
    fileformat: str,
    savemode: str = "append",
    groupbyfields: str | Sequence[str] | None = None,
    coalescefilecount: int | None = None,
    sparkoptions: Mapping[str, str] | None = None,
    rebalance: bool = True,
) -> None:
    """Write a batch frame.

    A partitioned layout is rebalanced by its partition columns first: small partitions get one file instead of
    one per task, and AQE splits a hot one over several tasks. A given file count repartitions, so that the work
    before the write keeps its own parallelism.
    """
    if fileformat in SEQUENCE_CODECS:
        write_sequence_file(df, path, fileformat)
        return
    if fileformat not in FORMATS:
        raise ValueError(f"unknown file format {fileformat!r}; known: {', '.join([*FORMATS, *SEQUENCE_CODECS])}")
    if savemode.lower() not in SAVE_MODES:
        raise ValueError(f"unknown savemode {savemode!r}")
    check_unique_columns(df)
    partition_columns = column_names(groupbyfields)
    if coalescefilecount:
        df = df.repartition(int(coalescefilecount))
    elif partition_columns and rebalance:
        df = df.hint("rebalance", *partition_columns)
    writer = df.write.format(fileformat).mode(SAVE_MODES[savemode.lower()]).option("header", "true")
    writer = writer.options(**(sparkoptions or {}))
    if partition_columns:
        writer = writer.partitionBy(*partition_columns)
    with file_size(df.sparkSession):
        writer.save(path)


def write_sequence_file(df: DataFrame, path: str, fileformat: str = "sequencefile") -> None:
    """(row index, row JSON) pairs. Spark has no DataFrame writer for sequence files, hence the RDD."""
    # numbering counts the rows of every task first, so they have to be the same both times, in the order they came
    numbered = settled(df.withColumn("__row", F.monotonically_increasing_id()))
    rows = numbered.orderBy("__row").drop("__row").toJSON().zipWithIndex().map(lambda pair: (pair[1], pair[0]))
    rows.saveAsSequenceFile(path, SEQUENCE_CODECS[fileformat])


def write_raw_json(df: DataFrame, path: str, savemode: str = "append") -> None:
    """The first column, which already holds JSON text, one document per line. A row without a document is an error."""
    first = F.col(f"`{df.columns[0]}`").cast("string")
    text = F.coalesce(first, F.raise_error(F.lit("a row has no JSON document")).cast("string")).alias("value")
    df.select(text).write.mode(SAVE_MODES[savemode.lower()]).text(path)
