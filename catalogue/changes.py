"""Change data and partition maintenance. Orders are the base table; each line item is a change of its order."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalogue.registry import dated, files, query, source, table
from rowferry import move, scratch_dir
from rowferry.operators import (
    append_copy,
    compact_changes,
    drop_partitions,
    missing_rows,
    replace_partitions,
)
from rowferry.session import Files
from rowferry.sinks import write_files

# bytes of the given line items that make up one file of `compact_packed`
SLICE_BYTES = 16 * 1024 * 1024

# A returned item deletes its order; other items carry a new price.
CHANGE_LOG = """
    SELECT o_orderkey, l_extendedprice AS price, o_orderdate AS created, l_shipdate AS updated,
           l_returnflag = 'R' AS gone
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""
COMPACTED = f"""
    WITH log AS ({CHANGE_LOG}),
    stacked AS (
        SELECT o_orderkey, o_totalprice AS price, o_orderdate AS created, o_orderdate AS updated, FALSE AS gone
        FROM orders WHERE o_orderdate IN (SELECT created FROM log)
        UNION ALL
        SELECT o_orderkey, price, created,
               CASE WHEN gone THEN TIMESTAMP '3000-01-01 00:00:00' ELSE updated END, gone
        FROM log),
    ranked AS (
        SELECT *, ROW_NUMBER() OVER (
            PARTITION BY o_orderkey ORDER BY gone DESC, updated DESC, price DESC) AS rn
        FROM stacked)
    SELECT o_orderkey, price, STRFTIME(created, '%Y%m%d%H') AS part, STRFTIME(updated, '%Y-%m-%d') AS updated
    FROM ranked WHERE rn = 1"""


def _base(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey", "o_totalprice price", "o_orderdate created", "o_orderdate updated"
    )


def _log(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderdate").alias("created"))
    lines = table(spark, sf_dir, "lineitem")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).selectExpr(
        "o_orderkey", "l_extendedprice price", "created", "l_shipdate updated", "l_returnflag = 'R' gone"
    )


def _compacted(spark: SparkSession, sf_dir: str, drop_deletes: bool) -> DataFrame:
    return compact_changes(
        _base(spark, sf_dir),
        _log(spark, sf_dir),
        "o_orderkey",
        "created",
        "updated",
        F.col("gone"),
        drop_deletes,
        [F.desc("price")],
    ).select(
        "o_orderkey",
        "price",
        F.date_format("created", "yyyyMMddHH").alias("part"),
        F.date_format("updated", "yyyy-MM-dd").alias("updated"),
    )


@query(COMPACTED)
def cdc_compact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _compacted(spark, sf_dir, drop_deletes=False)


@query(f"{COMPACTED} AND NOT gone")
def cdc_compact_drop_deletes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _compacted(spark, sf_dir, drop_deletes=True)


@query("""
    WITH returned AS (SELECT DISTINCT l_orderkey FROM lineitem WHERE l_returnflag = 'R'),
    touched AS (SELECT DISTINCT o_orderpriority FROM orders WHERE o_orderstatus <> 'P' AND o_orderpriority <> '5-LOW')
    SELECT o_orderkey, o_orderpriority,
           CASE WHEN o_orderpriority IN (SELECT o_orderpriority FROM touched) THEN 'new' ELSE 'old' END AS version
    FROM orders
    WHERE o_orderpriority NOT IN (SELECT o_orderpriority FROM touched)
       OR (o_orderpriority <> '1-URGENT' AND o_orderkey NOT IN (SELECT l_orderkey FROM returned))""")
def replace_partitions_emptied(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Partitions recomputed without returned orders; `1-URGENT` is left without rows and therefore dropped."""
    path = scratch_dir(spark, "partitions")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", F.lit("old").alias("version"))
    orders.write.partitionBy("o_orderpriority").parquet(path)
    affected = table(spark, sf_dir, "orders").where("o_orderstatus <> 'P' AND o_orderpriority <> '5-LOW'")
    returned = table(spark, sf_dir, "lineitem").where("l_returnflag = 'R'").selectExpr("l_orderkey o_orderkey")
    kept = missing_rows(orders.where("o_orderpriority NOT IN ('1-URGENT', '5-LOW')"), returned, "o_orderkey")
    recomputed = kept.withColumn("version", F.lit("new"))
    replace_partitions(recomputed, path, "parquet", ["o_orderpriority"], affected)
    return spark.read.parquet(path)


@query("""
    SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderstatus = 'F' THEN -o_totalprice ELSE o_totalprice END AS price
    FROM orders WHERE o_orderstatus <> 'F' OR o_totalprice < 250000""", name="replace_partitions")
def replace_partitions_by_command(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As a job: written to a temporary dataset, then copied over the partitions of the same name."""
    path, temporary = scratch_dir(spark, "base"), scratch_dir(spark, "temporary")
    text = "SELECT o_orderkey, o_orderstatus, o_totalprice AS price FROM o"
    job = {"source": source(sf_dir, "orders", "o"), "sql": {"query": text}}
    move(spark, {**job, "destination": files(path, "parquet", groupbyfields="o_orderstatus")})
    text = (
        "SELECT o_orderkey, o_orderstatus, -o_totalprice AS price FROM o "
        "WHERE o_orderstatus = 'F' AND o_totalprice < 250000"
    )
    command = {
        "operation": "copy",
        "sourcepath": temporary,
        "destinationpath": path,
        "partitioned": True,
        "removesource": True,
    }
    destination = files(temporary, "parquet", groupbyfields="o_orderstatus", post_migrate_command=command)
    move(spark, {**job, "sql": {"query": text}, "destination": destination})
    return spark.read.parquet(path)


@query(
    "SELECT c_custkey AS id, c_name AS name FROM customer UNION ALL SELECT s_suppkey, s_name FROM supplier",
    name="append_copy",
)
def append_copied(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, added = scratch_dir(spark, "kept"), scratch_dir(spark, "added")
    table(spark, sf_dir, "customer").selectExpr("c_custkey id", "c_name name").write.parquet(path)
    table(spark, sf_dir, "supplier").selectExpr("s_suppkey id", "s_name name").write.parquet(added)
    append_copy(spark, added, path, "parquet")
    return spark.read.parquet(path)


@query("""
    SELECT l_returnflag, l_linestatus, COUNT(*) AS n FROM lineitem
    WHERE NOT (l_returnflag = 'R' OR (l_returnflag = 'A' AND l_linestatus = 'O'))
    GROUP BY ALL""", name="drop_partitions")
def dropped_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "dropped")
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_returnflag", "l_linestatus")
    write_files(lines, path, "parquet", groupbyfields="l_returnflag,l_linestatus")
    drop_partitions(spark, path, [{"l_returnflag": "R"}, {"l_returnflag": "A", "l_linestatus": "O"}])
    return spark.read.parquet(path).groupBy("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"))


AWKWARD = """
    SELECT CAST(c_custkey AS {text}) AS id, CASE c_custkey % 5 WHEN 0 THEN NULL WHEN 1 THEN ''
           WHEN 2 THEN concat('a, "b"; ', c_name, ' ') ELSE c_name END AS note,
           c_mktsegment AS segment FROM {table}"""


def _copied(spark: SparkSession, sf_dir: str, delimiter: str, **command) -> DataFrame:
    """As a job: awkward text is written to a delimited dataset, whose files a command copies."""
    path, copy = scratch_dir(spark, "delimited"), scratch_dir(spark, "copied")
    spaces = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false", "sep": delimiter}
    command = {"operation": "copy", "sourcepath": path, "destinationpath": copy, "delimiter": delimiter, **command}
    layout = {"groupbyfields": "segment"} if command.get("partitioned") else {}
    job = {"source": source(sf_dir, "customer", "c"), "sql": {"query": AWKWARD.format(text="string", table="c")}}
    move(spark, {**job, "destination": files(path, "csv", sparkoptions=spaces, post_migrate_command=command, **layout)})
    # what is empty in quotes is an empty text, what is empty without is null
    return spark.read.options(header="true", sep=delimiter, nullValue="\x01").csv(copy).select("id", "note", "segment")


@query(AWKWARD.format(text="VARCHAR", table="customer"))
def copy_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _copied(spark, sf_dir, ",")


@query(AWKWARD.format(text="VARCHAR", table="customer"))
def copy_tsv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _copied(spark, sf_dir, "\t", partitioned=True, removesource=True)


@query("""
    SELECT CAST(o_orderkey AS VARCHAR) AS id, o_orderstatus AS part FROM orders
    UNION ALL SELECT l_orderkey || '/' || l_linenumber, l_returnflag FROM lineitem""")
def append_copy_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, added = scratch_dir(spark, "kept"), scratch_dir(spark, "added")
    orders = table(spark, sf_dir, "orders").selectExpr("string(o_orderkey) id", "o_orderstatus part")
    orders.write.partitionBy("part").parquet(path)
    lines = table(spark, sf_dir, "lineitem").selectExpr("concat(l_orderkey, '/', l_linenumber) id", "l_returnflag part")
    lines.write.partitionBy("part").parquet(added)
    append_copy(spark, added, path, "parquet")
    return spark.read.parquet(path)


@query("""
    SELECT l_returnflag, l_linestatus, COUNT(*) AS n FROM lineitem
    WHERE l_linestatus <> 'O' AND l_returnflag <> 'R' GROUP BY ALL""")
def drop_partitions_inner(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As commands of a job: by an inner partition column, and by one given out of order."""
    path = scratch_dir(spark, "dropped")
    dropped = [{"l_linestatus": "O"}, {"l_linestatus": "F", "l_returnflag": "R"}]
    command = {"operation": "drop_partitions", "path": path, "partitions": dropped}
    layout = {"groupbyfields": "l_returnflag,l_linestatus"}
    destination = files(path, "parquet", post_migrate_command=command, **layout)
    move(spark, {"source": source(sf_dir, "lineitem"), "destination": destination})
    return spark.read.parquet(path).groupBy("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"))


@query("""SELECT '{"id":' || c_custkey || ',"note":null,"name":"' || c_name || '"}' AS value FROM customer""")
def compact_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As commands of a job: documents with null fields, in many files and then in one."""
    path = scratch_dir(spark, "documents")
    text = """SELECT concat('{"id":', c_custkey, ',"note":null,"name":"', c_name, '"}') AS doc FROM c"""
    command = {"operation": "compact", "path": path, "filecount": 1}
    destination = files(path, "json", rowfromjsonstring="true", post_migrate_command=command)
    move(spark, {"source": source(sf_dir, "customer", "c"), "sql": {"query": text}, "destination": destination})
    return spark.read.text(path)


@query("""
    SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders
    WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')""")
def delete_rows_by_command(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As commands of a job, into a partitioned dataset that keeps its layout."""
    path = scratch_dir(spark, "orders")
    selection = f"SELECT l_orderkey AS o_orderkey FROM parquet.`{sf_dir}/lineitem.parquet` WHERE l_returnflag = 'R'"
    command = {"operation": "delete_rows", "path": path, "selection": selection, "mappingid": "o_orderkey"}
    text = "SELECT o_orderkey, o_totalprice, o_orderstatus FROM o"
    destination = files(path, "parquet", groupbyfields="o_orderstatus", post_migrate_command=command)
    move(spark, {"source": source(sf_dir, "orders", "o"), "sql": {"query": text}, "destination": destination})
    return spark.read.parquet(path)


@query("""
    SELECT l_orderkey AS id, l_extendedprice AS price, 'items' AS part, TRUE AS kept, 1 AS files FROM lineitem
    UNION ALL SELECT o_orderkey, o_totalprice, 'orders', FALSE, 1 FROM orders""")
def compact_packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As a command of a job: the small files that daily moves left are packed into one; the large file stays as it is.

    Tables above the size of one file are cut into slices, folders that have one large file each.
    """
    path = scratch_dir(spark, "packed")
    slices = 1 + Files(spark).size(f"{sf_dir}/lineitem.parquet") // SLICE_BYTES
    text = "SELECT {0}_orderkey AS id, {1} AS price, '{2}' AS part, pmod(xxhash64({0}_orderkey), {3}) AS slice FROM {0}"
    # a slice is written by one task, so that it is one file; rebalanced ones are split
    destination = files(path, "parquet", groupbyfields="part,slice", rebalance="false")
    items = text.format("l", "l_extendedprice", "items", slices) + " DISTRIBUTE BY slice"
    move(spark, {"source": source(sf_dir, "lineitem", "l"), "sql": {"query": items}, "destination": destination})
    large = Files(spark).walk(path)
    command = {"operation": "compact", "path": path, "targetbytes": min(size for _, size in large)}
    for day in range(3):
        if day == 2:
            destination = {**destination, "post_migrate_command": command}
        orders = text.format("o", "o_totalprice", "orders", slices) + f" WHERE o_orderkey % 3 = {day} DISTRIBUTE BY slice"
        move(spark, {"source": source(sf_dir, "orders", "o"), "sql": {"query": orders}, "destination": destination})
    stored = spark.read.parquet(path)
    counted = Counter(tuple(f.partition("=")[2] for f in name.split("/")[:2]) for name, _ in Files(spark).walk(path))
    n_files = spark.createDataFrame([(*k, n) for k, n in counted.items()], "part string, slice string, files int")
    stored = stored.withColumn("__name", F.col("_metadata.file_name")).join(F.broadcast(n_files), ["part", "slice"])
    kept = F.col("__name").isin([name.rpartition("/")[2] for name, _ in large]).alias("kept")
    return stored.select("id", "price", "part", kept, "files")


@query("""
    WITH log AS (
        SELECT o_orderkey AS id, l_extendedprice AS price, l_shipdate AS updated, o_orderpriority AS part,
               l_returnflag = 'R' AS gone
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_orderpriority IN ('1-URGENT', '3-MEDIUM')),
    stacked AS (
        SELECT o_orderkey AS id, o_totalprice AS price, o_orderdate AS updated, o_orderpriority AS part, FALSE AS gone
        FROM orders
        UNION ALL SELECT id, price, CASE WHEN gone THEN TIMESTAMP '3000-01-01 00:00:00' ELSE updated END, part, gone FROM log),
    ranked AS (
        SELECT *, ROW_NUMBER() OVER (PARTITION BY id ORDER BY gone DESC, updated DESC, price DESC) AS rn FROM stacked)
    SELECT id, price, STRFTIME(updated, '%Y-%m-%d') AS updated, part, part NOT IN ('1-URGENT', '3-MEDIUM') AS kept
    FROM ranked WHERE rn = 1 AND NOT gone""")
def cdc_compact_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As a command of a job: a change log is merged into a partitioned dataset; `kept` tells files that stayed."""
    path = scratch_dir(spark, "compacted")
    text = "SELECT o_orderkey AS id, o_totalprice AS price, o_orderdate AS updated, o_orderpriority AS part FROM o"
    job = {"source": source(sf_dir, "orders", "o"), "sql": {"query": text}}
    move(spark, {**job, "destination": files(path, "parquet", groupbyfields="part")})
    before = [name.rpartition("/")[2] for name, _ in Files(spark).walk(path)]
    command = {
        "operation": "compact_changes",
        "path": path,
        "changes": "SELECT * FROM log",
        "mappingid": "id",
        "scope": "part",
        "updatedfield": "updated",
        "deletedwhen": "operation = 1",
        "dropdeletes": True,
        "orderby": ["price"],
    }
    log = """
        SELECT o_orderkey AS id, l_extendedprice AS price, l_shipdate AS updated, o_orderpriority AS part,
               if(l_returnflag = 'R', 1, 2) AS operation
        FROM l JOIN o ON l_orderkey = o_orderkey WHERE o_orderpriority IN ('1-URGENT', '3-MEDIUM')"""
    staged = scratch_dir(spark, "log")
    sources = [source(sf_dir, "orders", "o"), source(sf_dir, "lineitem", "l")]
    move(spark, {"sources": sources, "sql": {"query": log}, "destination": files(staged, "parquet")})
    counted = {"platform": "console", "post_migrate_command": command}
    job = {"source": files(staged, "parquet", alias="log"), "sql": {"query": "SELECT count(*) AS n FROM log"}}
    move(spark, {**job, "destination": counted})
    kept = F.col("_metadata.file_name").isin(before).alias("kept")
    return spark.read.parquet(path).select("id", "price", F.date_format("updated", "yyyy-MM-dd").alias("updated"), "part", kept)


@query("""
    SELECT event_id, STRFTIME(ts, '%Y-%m-%d %H:%M:%S') AS ts FROM events
    WHERE ts > TIMESTAMP '2024-01-05 00:00:00' AND ts <= TIMESTAMP '2024-01-25 00:00:00'""")
def watermark_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As a job that runs three times: each run moves what came since the last one, and every row once."""
    path, state = scratch_dir(spark, "moved"), scratch_dir(spark, "state")
    mark = {"path": state, "name": "events", "start": "2024-01-05 00:00:00", "column": "ts"}
    for until in ("2024-01-11 00:00:00", "2024-01-11 07:30:00", "2024-01-25 00:00:00"):
        job = {"source": source(sf_dir, "events"), "watermark": {**mark, "until": until}}
        move(spark, {**job, "destination": files(path, "parquet", savemode="append")})
    return dated(spark.read.parquet(path).select("event_id", "ts"), "ts")
