"""What the operators share: words, stored intermediate tables, batches of bounded size, connected components."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator

from pyspark import cloudpickle
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rowferry.session import Files, scratch_dir

# the white space that separates words everywhere in this subpackage
SPACES = " \t\n\x0b\f\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"
# free the shuffle files of a query when it ends
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# rows and bytes that one Arrow batch between Spark and Python may hold
BATCH_ROWS = 512
BATCH_BYTES = "16m"
# a table of at most this many rows may be broadcast after its rows were counted
BROADCAST_ROWS = 50_000


def store(df: DataFrame, label: str = "llm") -> DataFrame:
    """The frame written to the shared scratch folder and read again: computed once, safe from lost executors.

    Its shuffle files go when it is written, the folder goes with `discard` or when the application ends.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(SHUFFLE_CLEANUP) if before is None else spark.conf.set(SHUFFLE_CLEANUP, before)
    Files(spark).delete_on_exit(path)
    stored = spark.read.schema(df.schema).parquet(path)
    stored.stored_at = path
    return stored


def discard(*stored: DataFrame) -> None:
    """Delete stored tables that nothing reads any more."""
    for df in stored:
        Files(df.sparkSession).delete(df.stored_at)


def numbered(docs: DataFrame, *columns: Column | str) -> DataFrame:
    """The given columns of all rows with `row`, a number of their own that is the same in every pass.

    How files are cut into tasks changes with the cores at hand, so a row of a Parquet file is numbered by its file and its
    place there. Any other frame is stored with its numbers and read from then on.
    """
    plan = docs._jdf.queryExecution().optimizedPlan().toString()
    scanned = all(line.lstrip(" +-:").startswith(("Relation", "Project", "Filter")) for line in plan.splitlines())
    if scanned and "rand" not in plan:
        try:
            placed = docs.select(F.col("_metadata.file_path").alias("__file"), F.col("_metadata.row_index").alias("__at"), *columns)
        except AnalysisException:
            placed = None
        if placed is not None:
            # names of files alone, read without any column
            names = placed.select("__file").distinct().limit(BROADCAST_ROWS + 1).collect()
            if len(names) <= BROADCAST_ROWS:
                pairs = [(r["__file"], i << 40) for i, r in enumerate(sorted(names))]
                first = docs.sparkSession.createDataFrame(pairs, "__file string, __first long")
                rows = placed.join(F.broadcast(first), "__file").withColumn("row", F.col("__first") + F.col("__at"))
                return rows.select("row", *placed.columns[2:])
    return store(docs.select(F.monotonically_increasing_id().alias("row"), *columns), "rows")


def bounded_batches(spark: SparkSession) -> None:
    """Keep Arrow batches small, since one row may hold a very long text."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def shared(spark: SparkSession, value: object) -> Callable[[], object]:
    """A value of bounded size on every executor, whose classes need not be installed there; call it once per task."""
    sent = spark.sparkContext.broadcast(cloudpickle.dumps(value))
    return lambda: pickle.loads(sent.value)


def broadcast_if_small(df: DataFrame) -> DataFrame:
    """A stored frame with a broadcast hint when its counted rows are few; otherwise as it is, for a shuffled join."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def split_words(text: Column) -> Column:
    """The words of a text as an array; none for an empty or null text."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE_RUN))


def utf8(values) -> Iterator[bytes]:
    """The texts of an Arrow string column as UTF-8 bytes, null as empty."""
    import pyarrow as pa

    for value in values.cast(pa.large_binary()).to_pylist():
        yield value or b""


def log_gamma(z: Column) -> Column:
    """ln of the gamma function for z > 0: Stirling's series at z + 8, carried down by the recurrence."""
    shifted = z + 8
    series = (shifted - 0.5) * F.ln(shifted) - shifted + 0.9189385332046727 + 1 / (12 * shifted)
    series = series - 1 / (360 * F.pow(shifted, 3)) + 1 / (1260 * F.pow(shifted, 5)) - 1 / (1680 * F.pow(shifted, 7))
    for step in range(8):
        series = series - F.ln(z + step)
    return series


def components(edges: DataFrame) -> DataFrame:
    """Connected components of edges (a, b): node and root, the smallest node reachable, for every node with an edge.

    Alternates the large-star and small-star steps: every node's larger neighbours move to its smallest one, then its
    smaller ones do. Each round is an aggregation with a map-side minimum and a join; rounds grow with the logarithm of
    the number of nodes. Loops and repeated edges are allowed; edges with a null end are left out.
    """
    known = edges.filter("a IS NOT NULL AND b IS NOT NULL")
    links = known.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    links = store(links.filter("u != v").distinct())
    before = None
    while True:
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = store(large)
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.unionByName(least.withColumnRenamed("m", "v"))
        small = small.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
        old, links = links, store(small)
        discard(old, large)
        state = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    # every edge now leads from a node to its root
    leaves = links.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return leaves.unionByName(links.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
