"""Job sessions, shared scratch space and the small file-system helpers built on Hadoop's API."""

from __future__ import annotations

import math
import tempfile
import uuid
from collections.abc import Iterable, Mapping

from py4j.protocol import Py4JError, Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

# Settings every job starts from; a job's own `properties` override them.
JOB_DEFAULTS = {
    # jobs expect a bad cast to give null
    "spark.sql.ansi.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    # with pruning on, count() keeps malformed CSV rows that collect() drops
    "spark.sql.csv.parser.columnPruning.enabled": "false",
    # split skewed join partitions even when that adds a shuffle further up
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}
# A task that writes to up to as many partition folders keeps their files open; with more it sorts its rows by folder.
OPEN_FILES = ("spark.sql.maxConcurrentOutputFileWriters", "16")
# Settings a job starts from where the given session leaves them unset: stream state is kept outside the heap, the state
# of a join in one store for each task, and a batch checkpoints only what it changed, densely packed; partitioned writes
# hold no rows in memory.
UNSET_DEFAULTS = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
    "spark.sql.streaming.stateStore.rocksdb.compression": "zstd",
    "spark.sql.streaming.stateStore.compression.codec": "zstd",
    "spark.sql.streaming.join.stateFormatVersion": "3",
    OPEN_FILES[0]: OPEN_FILES[1],
}
INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
# settings of a session or job: bytes that a shuffle partition should hold, and the most partitions of a shuffle; every
# task of a shuffle writes a block per partition, so their number has to stay moderate
PARTITION_BYTES = ("spark.rowferry.shufflePartitionBytes", 256 * 1024 * 1024)
MOST_PARTITIONS = ("spark.rowferry.mostShufflePartitions", 20000)
# Catalyst's estimate for a relation it knows nothing about is of this order; such a source counts as one of this size
UNKNOWN_SIZE, ASSUMED_SIZE = 1 << 60, 1 << 36


def job_session(spark: SparkSession, properties: Mapping[str, object] | None = None) -> SparkSession:
    """A session with its own views, functions and settings on the same cluster and catalog."""
    session = spark.newSession()
    fresh, given = session.conf.getAll, spark.conf.getAll
    for key, value in given.items():
        # static settings are the same in every session of an application, so what differs can be set
        if key.startswith("spark.sql.") and fresh.get(key) != value:
            session.conf.set(key, value)
    unset = {key: value for key, value in UNSET_DEFAULTS.items() if key not in given}
    for key, value in {**JOB_DEFAULTS, **unset, **(properties or {})}.items():
        session.conf.set(key, str(value).lower() if isinstance(value, bool) else str(value))
    return session


def is_local(spark: SparkSession) -> bool:
    """Whether all tasks run in the driver's own process; `local-cluster` has executors of its own."""
    master = spark.sparkContext.master
    return master == "local" or master.startswith("local[")


def scratch_dir(spark: SparkSession, label: str = "work") -> str:
    """A fresh folder below the cluster's shared `spark.checkpoint.dir`.

    Only a local master, where every task runs in this process, may fall back to a temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not is_local(spark):
            raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
        root = tempfile.mkdtemp(prefix="rowferry-")
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex[:12]}"


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of a frame: metadata only, no job is run."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def broadcast_limit(spark: SparkSession) -> int:
    """`spark.sql.autoBroadcastJoinThreshold` in bytes (-1 when broadcasting is off)."""
    return spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()


def is_small(df: DataFrame) -> bool:
    """True when Catalyst itself would broadcast this frame."""
    return estimated_bytes(df) <= broadcast_limit(df.sparkSession)


def size_shuffles(spark: SparkSession, sources: Iterable[DataFrame]) -> None:
    """Let AQE start from enough shuffle partitions for the sources of a job; it merges those that turn out small.

    A source of unknown size (JDBC, Kafka, stores) counts as a large one, and a number that the session names itself is
    kept.
    """
    if spark.conf.get(INITIAL_PARTITIONS, None) is not None:
        return
    sizes = [estimated_bytes(df) for df in sources if not df.isStreaming]
    per_partition, most = (int(spark.conf.get(key, str(default))) for key, default in (PARTITION_BYTES, MOST_PARTITIONS))
    needed = math.ceil(sum(size if size < UNKNOWN_SIZE else ASSUMED_SIZE for size in sizes) / per_partition)
    if needed > int(spark.conf.get("spark.sql.shuffle.partitions")):
        spark.conf.set(INITIAL_PARTITIONS, str(min(needed, most)))


def settled(df: DataFrame) -> DataFrame:
    """The frame, written to the scratch folder and read back: computed once, with a size that Catalyst knows.

    The folder goes with `discard`, or when the application ends.
    """
    path = scratch_dir(df.sparkSession, "settled")
    df.write.parquet(path)
    Files(df.sparkSession).delete_on_exit(path)
    stored = df.sparkSession.read.schema(df.schema).parquet(path)
    stored.stored_at = path
    return stored


def discard(*stored: DataFrame) -> None:
    """Delete settled frames that nothing reads any more."""
    for df in stored:
        Files(df.sparkSession).delete(df.stored_at)


class Written:
    """The bytes that Spark's tasks wrote, to files or tables, while a block ran in this thread; None if none is known.

    Jobs are told apart by a group of their own, so that blocks of other threads are not counted. Tables that the work
    itself needed count as well.
    """

    GROUP = "spark.jobGroup.id"

    def __init__(self, spark: SparkSession):
        self._context, self._group = spark.sparkContext, f"rowferry-{uuid.uuid4().hex}"
        self.bytes: int | None = None

    def __enter__(self) -> Written:
        self._before = self._context.getLocalProperty(self.GROUP)
        self._context.setLocalProperty(self.GROUP, self._group)
        return self

    def __exit__(self, *_: object) -> None:
        self._context.setLocalProperty(self.GROUP, self._before)
        scala = self._context._jsc.sc()
        store, total = scala.statusStore(), 0
        tracker = self._context.statusTracker()
        try:
            scala.listenerBus().waitUntilEmpty(10_000)
            stages = {s for job in tracker.getJobIdsForGroup(self._group) for s in tracker.getJobInfo(job).stageIds}
        except (AttributeError, Py4JError):
            return
        for stage in stages:
            try:
                total += store.lastStageAttempt(stage).outputBytes()
            except Py4JError:
                # skipped, as its output was there
                continue
        self.bytes = total or None


class Files:
    """Metadata operations on a Hadoop path; no data passes through the driver."""

    def __init__(self, spark: SparkSession):
        self._jvm = spark._jvm
        self._conf = spark._jsc.hadoopConfiguration()

    def _path(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def _fs(self, path: str):
        return self._path(path).getFileSystem(self._conf)

    def exists(self, path: str) -> bool:
        return self._fs(path).exists(self._path(path))

    def is_file(self, path: str) -> bool:
        return self.exists(path) and self._fs(path).getFileStatus(self._path(path)).isFile()

    def size(self, path: str) -> int:
        return self._fs(path).getContentSummary(self._path(path)).getLength()

    def delete(self, path: str) -> bool:
        return self._fs(path).delete(self._path(path), True)

    def delete_on_exit(self, path: str) -> None:
        """Delete a folder when the application ends."""
        self._fs(path).deleteOnExit(self._path(path))

    def rename(self, source: str, target: str) -> None:
        if not self._fs(source).rename(self._path(source), self._path(target)):
            raise OSError(f"could not rename {source} to {target}")

    def qualified(self, path: str) -> str:
        """The path with scheme and authority, as a plain text."""
        return self._fs(path).makeQualified(self._path(path.rstrip("/") or "/")).toString()

    def make_folder(self, path: str) -> None:
        self._fs(path).mkdirs(self._path(path))

    def write_text(self, path: str, text: str) -> None:
        """Write a small file, on the driver."""
        stream = self._fs(path).create(self._path(path), True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()

    def create_text(self, path: str, text: str) -> bool:
        """Write a small file unless there is one, which is then left as it is: False. One of several callers succeeds."""
        try:
            stream = self._fs(path).create(self._path(path), False)
        except Py4JJavaError as error:
            if "FileAlreadyExists" in error.java_exception.toString() or self.exists(path):
                return False
            raise
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        return True

    def read_text(self, path: str) -> str:
        stream = self._fs(path).open(self._path(path))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def walk(self, path: str) -> list[tuple[str, int]]:
        """The data files at any depth below a folder, named from it, with their sizes; none where it does not exist."""
        if not self.exists(path):
            return []
        root, found = self.qualified(path), []
        listed = self._fs(path).listFiles(self._path(path), True)
        while listed.hasNext():
            status = listed.next()
            name = status.getPath().toString()[len(root) + 1 :]
            # as Spark's own listing: hidden names are no data
            if not any(p.startswith(".") or (p.startswith("_") and "=" not in p) for p in name.split("/")):
                found.append((name, status.getLen()))
        return found

    def children(self, path: str) -> list[str]:
        return [s.getPath().getName() for s in self._fs(path).listStatus(self._path(path))]
