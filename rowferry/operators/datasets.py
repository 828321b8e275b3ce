"""Maintenance of file datasets: partition replacement, copies, drops and compaction."""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import NullType

from rowferry.operators.swap import BIN, recover, refuse_pending, replace_files
from rowferry.session import OPEN_FILES, Files, discard, settled

TARGET_FILE_BYTES = 128 * 1024 * 1024
# a file of this share of the target, or more, is large enough
SMALL = 0.75
# delimited files are written again with all the white space that was read
AS_READ = {"header": "true", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A session setting for the length of a block."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


@contextmanager
def file_size(spark: SparkSession, target_bytes: int = TARGET_FILE_BYTES) -> Iterator[None]:
    """The size AQE aims at for rebalanced writes inside the block, unless the session names one; folders written unsorted."""
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    with open_files(spark):
        if spark.conf.get(key, None) is not None:
            yield
        else:
            with setting(spark, key, str(target_bytes)):
                yield


@contextmanager
def open_files(spark: SparkSession) -> Iterator[None]:
    """Partitioned writes inside the block keep a file open per folder instead of sorting, unless the session says how many.

    A task's rows are small when packed for the exchange and may be very many; a sort would hold them all.
    """
    key, most = OPEN_FILES
    if spark.conf.get(key, None) is not None:
        yield
    else:
        with setting(spark, key, most):
            yield


def text_options(
    delimiter: str = ",", charset: str = "utf-8", sparkoptions: Mapping[str, str] | None = None
) -> dict[str, str]:
    """How the files of a delimited dataset are written, for reading them and for writing them the same way again."""
    return {"header": "true", "delimiter": delimiter, "encoding": charset, **(sparkoptions or {})}


def read_partitioned(
    spark: SparkSession, path: str, fileformat: str, options: Mapping[str, str] | None = None
) -> DataFrame:
    """A dataset as it must be read to be written again without loss.

    Partition values stay text, so that `01` is written back as `01`, and the columns are those of all files. Delimited
    files are text throughout; a row that does not fit its header is an error.
    """
    options = {"header": "true", "mergeSchema": "true", "mode": "FAILFAST", **(options or {})}
    if fileformat == "csv":
        # an empty field in quotes is an empty text, one without is null; both are written that way again
        options = {"enforceSchema": "false", "nullValue": "\x01null", **options}
    with setting(spark, "spark.sql.sources.partitionColumnTypeInference.enabled", "false"):
        df = spark.read.format(fileformat).options(**options).load(path)
    # a partition column that is null everywhere has no type of its own
    untyped = {f.name: F.col(f"`{f.name}`").cast("string") for f in df.schema if isinstance(f.dataType, NullType)}
    return df.withColumns(untyped) if untyped else df


def partition_columns(spark: SparkSession, path: str) -> list[str]:
    """Partition columns from the folder names, outermost first."""
    files, columns = Files(spark), []
    while not files.is_file(path):
        folders = [n for n in files.children(path) if "=" in n and not n.startswith(("_", "."))]
        if not folders:
            break
        columns.append(folders[0].split("=", 1)[0])
        path = f"{path}/{folders[0]}"
    return columns


def partition_folder(spark: SparkSession, values: Mapping[str, object]) -> str:
    """The folder of a partition below its dataset, for column values outermost first."""
    name = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.getPartitionPathString
    return "/".join(name(c, None if v is None else str(v)) for c, v in values.items())


def replace_partitions(
    df: DataFrame,
    path: str,
    fileformat: str,
    partition_by: Sequence[str],
    affected: DataFrame | None = None,
    options: Mapping[str, str] | None = None,
) -> None:
    """Replace the partitions that occur in the frame and leave the others alone, all or nothing.

    `affected` names partitions that were recomputed; those left without rows are dropped.
    """
    columns, spark, base = list(partition_by), df.sparkSession, path.rstrip("/")
    files = Files(spark)
    refuse_pending(spark, base)
    refuse_other_layout(spark, base, columns)

    def old(new: list[str]) -> list[str]:
        folders = {name.rpartition("/")[0] for name in new}
        if affected is not None:
            # as folders know them: null and the empty text are the same partition
            touched = affected.select(*[F.nullif(F.col(c).cast("string"), F.lit("")).alias(c) for c in columns])
            folders.update(partition_folder(spark, row.asDict()) for row in touched.distinct().toLocalIterator())
        return [f"{folder}/{name}" for folder in folders for name, _ in files.walk(f"{base}/{folder}")]

    replace_files(spark, base, lambda staged: write_dataset(df, staged, fileformat, columns, options), old)


def write_dataset(
    df: DataFrame, path: str, fileformat: str, columns: Sequence[str] = (), options: Mapping[str, str] | None = None
) -> None:
    """Write files of the size that AQE aims at, a partitioned layout by its columns."""
    if columns:
        df = df.hint("rebalance", *columns)
    writer = df.write.format(fileformat).options(**{**AS_READ, **(options or {})})
    with file_size(df.sparkSession):
        (writer.partitionBy(*columns) if columns else writer).save(path)


def refuse_other_layout(spark: SparkSession, path: str, columns: Sequence[str]) -> None:
    """Raise where a dataset has other partition columns than the rows that come in: it could not be read afterwards."""
    files = Files(spark)
    if not files.exists(path) or all(n.startswith(("_", ".")) for n in files.children(path)):
        return
    if partition_columns(spark, path) != list(columns):
        kept = ", ".join(partition_columns(spark, path)) or "nothing"
        raise ValueError(f"{path} is partitioned by {kept}, the rows to add by {', '.join(columns) or 'nothing'}")


def copy_partitions(
    spark: SparkSession,
    source: str,
    destination: str,
    fileformat: str,
    removesource: bool = False,
    options: Mapping[str, str] | None = None,
) -> None:
    """Replace the destination's partitions by the source's partitions of the same name.

    The source is removed only when the destination's partitions of those names hold as many rows as it. A destination
    with other partition columns is refused.
    """
    recover(spark, source)
    recover(spark, destination)
    columns = partition_columns(spark, source)
    if not columns:
        raise ValueError(f"{source} has no partition folders")
    fileformat = _copied_as(fileformat)
    df = read_partitioned(spark, source, fileformat, options)
    replace_partitions(df, destination, fileformat, columns, options=options)
    if removesource:
        stored = read_partitioned(spark, destination, fileformat, options)
        names = df.select(*columns).distinct()
        same = [stored[f"`{c}`"].eqNullSafe(names[f"`{c}`"]) for c in columns]
        given, copied = df.count(), stored.join(names, same, "left_semi").count()
        if given != copied:
            raise RuntimeError(f"{source} has {given} rows, its copy {copied}; the source stays")
        Files(spark).delete(source)


def _copied_as(fileformat: str) -> str:
    """JSON documents are copied line by line: parsing them could change numbers and lose empty fields."""
    return "text" if fileformat == "json" else fileformat


def append_copy(
    spark: SparkSession, source: str, destination: str, fileformat: str, options: Mapping[str, str] | None = None
) -> None:
    """Add the rows of one dataset to another, in the partition folders of the source, which the other has to share."""
    recover(spark, source)
    recover(spark, destination)
    fileformat, columns = _copied_as(fileformat), partition_columns(spark, source)
    refuse_other_layout(spark, destination, columns)
    df = read_partitioned(spark, source, fileformat, options)
    if columns:
        df = df.hint("rebalance", *columns)
    writer = df.write.mode("append").options(**{**AS_READ, **(options or {})}).format(fileformat)
    with file_size(spark):
        (writer.partitionBy(*columns) if columns else writer).save(destination)


def drop_partitions(spark: SparkSession, path: str, partitions: Sequence[Mapping[str, object]]) -> int:
    """Delete the partitions that have the given column values, for any of the columns; returns how many folders."""
    recover(spark, path)
    files, columns, dropped = Files(spark), partition_columns(spark, path), 0

    def matching(folder: str, rest: list[str], names: Mapping[str, str]) -> Iterator[str]:
        if not names:
            yield folder
        elif rest[0] in names:
            below = f"{folder}/{names[rest[0]]}"
            if files.exists(below):
                yield from matching(below, rest[1:], {c: n for c, n in names.items() if c != rest[0]})
        else:
            for name in files.children(folder):
                if name.startswith(f"{rest[0]}="):
                    yield from matching(f"{folder}/{name}", rest[1:], names)

    for values in partitions:
        unknown = [c for c in values if c not in columns]
        if unknown or not values:
            raise ValueError(f"{path} is partitioned by {', '.join(columns) or 'nothing'}, not by {', '.join(unknown)}")
        names = {c: partition_folder(spark, {c: v}) for c, v in values.items()}
        for folder in list(matching(path.rstrip("/"), columns, names)):
            dropped += bool(files.delete(folder))
    return dropped


def delete_dataset(spark: SparkSession, path: str) -> bool:
    return Files(spark).delete(path)


def refuse_stream_output(files: Files, path: str) -> None:
    """Raise for a folder that a stream writes to: new files would be unknown to its log, or the log be lost."""
    if files.exists(path) and not files.is_file(path):
        found = [n for n in files.children(path) if n in ("_spark_metadata", "_checkpoint")]
        if found:
            raise ValueError(f"{path} holds {' and '.join(found)} of a stream and cannot be rewritten in place")


def rewrite_dataset(
    df: DataFrame,
    path: str,
    fileformat: str,
    partition_by: Sequence[str] = (),
    options: Mapping[str, str] | None = None,
) -> None:
    """Replace all files of a dataset, from which the frame may read.

    The new content is complete before it takes the old one's place, see `swap`. Files of a stream's sink belong to
    its log, so those are refused.
    """
    spark, base = df.sparkSession, path.rstrip("/")
    refuse_stream_output(Files(spark), base)
    refuse_pending(spark, base)
    columns = list(partition_by)
    write = lambda staged: write_dataset(df, staged, fileformat, columns, options)
    replace_files(spark, base, write, lambda _: [name for name, _ in Files(spark).walk(base)])


def file_uri(spark: SparkSession, path: str, name: str) -> str:
    """A file of a dataset as Spark's `_metadata.file_path` has it."""
    return spark._jvm.org.apache.hadoop.fs.Path(f"{Files(spark).qualified(path)}/{name}").toUri().toString()


def file_name(spark: SparkSession, path: str, uri: str) -> str:
    """The name below its dataset of a file that `_metadata.file_path` gives."""
    plain = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(uri)).toString()
    return plain[len(Files(spark).qualified(path)) + 1 :]


def file_path() -> Column:
    """The file of a row, as a scan tells it."""
    return F.col("_metadata.file_path")


def with_file(df: DataFrame) -> DataFrame:
    """A scan with the file of every row as `__file`."""
    return df.select("*", file_path().alias("__file"))


def files_of(df: DataFrame, uris: Sequence[str]) -> DataFrame:
    """The rows of a scan that lie in the given files; the others are not read."""
    return df.where(file_path().isin(list(uris)) if uris else F.lit(False))


def packed(sizes: Mapping[str, int], target_bytes: int) -> list[list[str]]:
    """Files in bins of at most `target_bytes`, the largest first, each into the fullest bin that takes it."""
    free: list[tuple[int, int]] = []
    bins: list[list[str]] = []
    for name, size in sorted(sizes.items(), key=lambda item: (-item[1], item[0])):
        at = bisect_left(free, (size, -1))
        if at == len(free):
            bins.append([name])
            insort(free, (target_bytes - size, len(bins) - 1))
        else:
            left, which = free.pop(at)
            bins[which].append(name)
            insort(free, (left - size, which))
    return bins


def compact(
    spark: SparkSession,
    path: str,
    fileformat: str,
    filecount: int | None = None,
    target_bytes: int = TARGET_FILE_BYTES,
    options: Mapping[str, str] | None = None,
) -> None:
    """Rewrite small files into larger ones; files that are large enough stay as they are.

    Within each partition small files are packed into bins of `target_bytes`, and each bin of several files becomes one.
    With a `filecount` every partition, or the dataset if it has none, gets that many files; those that have them stay.
    """
    base = path.rstrip("/")
    refuse_stream_output(Files(spark), base)
    recover(spark, base)
    columns, fileformat = partition_columns(spark, base), _copied_as(fileformat)
    folders: dict[str, dict[str, int]] = {}
    for name, size in Files(spark).walk(base):
        folders.setdefault(name.rpartition("/")[0], {})[name] = size
    if filecount:
        whole = [list(f) for f in folders.values() if len(f) != filecount]
        bins = {name: i * filecount for i, names in enumerate(whole) for name in names}
        place = F.col(BIN) + F.pmod("__row", F.lit(filecount))
    else:
        small = [{n: s for n, s in f.items() if s < target_bytes * SMALL} for f in folders.values()]
        several = [names for f in small for names in packed(f, target_bytes) if len(names) > 1]
        bins = {name: i for i, names in enumerate(several) for name in names}
        place = F.col(BIN).cast("long")
    if not bins:
        return
    uris = [(file_uri(spark, base, name), number) for name, number in bins.items()]
    numbers = settled(spark.createDataFrame(uris, f"__file string, {BIN} long"))
    rows = files_of(read_partitioned(spark, base, fileformat, options), [uri for uri, _ in uris])
    rows = with_file(rows).withColumn("__row", F.monotonically_increasing_id()).join(numbers, "__file")
    rows = rows.withColumn(BIN, place).drop("__file", "__row").repartition(len(set(bins.values())) * (filecount or 1), BIN)
    writer = rows.write.format(fileformat).options(**{**AS_READ, **(options or {})}).partitionBy(BIN, *columns)
    with open_files(spark):
        replace_files(spark, base, writer.save, lambda _: bins)
    discard(numbers)
