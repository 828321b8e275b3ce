"""Sinks: formats, save modes, layouts, file counts, tables, rendered rows and log events."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalogue.registry import dated, files, moved, query, source, table
from rowferry import move, scratch_dir
from rowferry.operators import compact
from rowferry.sinks import log_events, render_rows


@query("SELECT p_partkey, p_name, p_brand, p_size, p_retailprice FROM part")
def sink_roundtrip_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = moved(spark, {"source": source(sf_dir, "part")}, "json")
    schema = "p_partkey bigint, p_name string, p_brand string, p_size int, p_retailprice double"
    return spark.read.schema(schema).json(path)


@query("SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def sink_roundtrip_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = moved(spark, {"source": source(sf_dir, "customer")}, "csv", sparkoptions={"sep": ";", "compression": "gzip"})
    schema = "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    return spark.read.schema(schema).options(header="true", sep=";").csv(path)


@query("SELECT * REPLACE (STRFTIME(l_shipdate, '%Y-%m-%d %H:%M:%S') AS l_shipdate) FROM lineitem")
def sink_roundtrip_orc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = moved(spark, {"source": source(sf_dir, "lineitem")}, "orc")
    return dated(spark.read.orc(path), "l_shipdate")


@query("SELECT * REPLACE (STRFTIME(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate) FROM orders")
def sink_roundtrip_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = moved(spark, {"source": source(sf_dir, "orders")}, "parquet")
    return dated(spark.read.parquet(path), "o_orderdate")


@query("SELECT c_custkey, c_acctbal FROM customer UNION ALL SELECT c_custkey, c_acctbal FROM customer")
def sink_append_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "append")
    job = {"source": source(sf_dir, "customer"), "destination": files(path, "parquet", savemode="Append")}
    move(spark, job)
    move(spark, job)
    return spark.read.parquet(path).select("c_custkey", "c_acctbal")


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F'")
def sink_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "overwrite")
    destination = files(path, "parquet", savemode="Overwrite")
    for status in ("O", "F"):
        text = f"SELECT o_orderkey, o_totalprice FROM o WHERE o_orderstatus = '{status}'"
        move(spark, {"source": source(sf_dir, "orders", "o"), "sql": {"query": text}, "destination": destination})
    return spark.read.parquet(path)


@query("""
    SELECT l_returnflag, l_linestatus, COUNT(*) AS n,
           CAST(SUM(CAST(l_extendedprice AS DECIMAL(18, 2))) AS DOUBLE) AS total
    FROM lineitem GROUP BY l_returnflag, l_linestatus""")
def sink_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = moved(spark, {"source": source(sf_dir, "lineitem")}, groupbyfields="l_returnflag,l_linestatus")
    total = F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("double")
    return spark.read.parquet(path).groupBy("l_returnflag", "l_linestatus").agg(
        F.count("*").alias("n"), total.alias("total")
    )


@query("""
    SELECT o_orderstatus, COUNT(*) AS n, CAST(3 AS BIGINT) AS most_files FROM orders GROUP BY o_orderstatus""")
def sink_filecount(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = moved(spark, {"source": source(sf_dir, "orders")}, coalescefilecount=3)
    written = spark.read.parquet(path).select("o_orderstatus", F.input_file_name().alias("file"))
    return written.groupBy("o_orderstatus").agg(F.count("*").alias("n"), F.count_distinct("file").alias("most_files"))


@query("""
    SELECT o_orderstatus, COUNT(*) AS n, CAST(1 AS BIGINT) AS files,
           CAST(SUM(CAST(o_totalprice AS DECIMAL(18, 2))) AS DOUBLE) AS total
    FROM orders GROUP BY o_orderstatus""")
def compact_dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "compact")
    table(spark, sf_dir, "orders").repartition(12).write.partitionBy("o_orderstatus").parquet(path)
    compact(spark, path, "parquet")
    written = spark.read.parquet(path).withColumn("file", F.input_file_name())
    total = F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double")
    return written.groupBy("o_orderstatus").agg(
        F.count("*").alias("n"), F.count_distinct("file").alias("files"), total.alias("total")
    )


@query("SELECT * REPLACE (STRFTIME(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate) FROM orders")
def sink_sequencefile(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = moved(spark, {"source": source(sf_dir, "orders")}, "sequencefiledeflate")
    rows = spark.sparkContext.sequenceFile(path).toDF("index bigint, json string")
    schema = table(spark, sf_dir, "orders").schema
    return dated(rows.select(F.from_json("json", schema).alias("row")).select("row.*"), "o_orderdate")


@query("SELECT c_custkey, c_name, c_acctbal FROM customer")
def sink_raw_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = "SELECT to_json(struct(c_custkey, c_name, c_acctbal)) AS doc FROM c"
    job = {"source": source(sf_dir, "customer", "c"), "sql": {"query": text}}
    path = moved(spark, job, "json", rowfromjsonstring="true")
    return spark.read.schema("c_custkey bigint, c_name string, c_acctbal double").json(path)


@query("SELECT p_partkey, p_name, p_retailprice, p_brand FROM part")
def sink_table_insert(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = f"part_by_brand_{uuid.uuid4().hex[:12]}"
    spark.sql(
        f"CREATE TABLE {name} (id BIGINT, title STRING, price DOUBLE, brand STRING) USING parquet "
        f"PARTITIONED BY (brand) LOCATION '{scratch_dir(spark, 'table')}'"
    )
    insert = {"platform": "hive", "database": "default", "table": name, "format": "parquet", "partitions": "true"}
    # the second run replaces the partitions of the first one, whose prices are wrong
    for price in ("0.0D", "p_retailprice"):
        text = f"SELECT p_partkey, p_name, {price}, p_brand FROM p"
        job = {"source": source(sf_dir, "part", "p"), "sql": {"query": text}}
        move(spark, {**job, "destination": {**insert, "savemode": "overwrite"}})
    return spark.table(name).selectExpr("id p_partkey", "title p_name", "price p_retailprice", "brand p_brand")


@query("""
    SELECT CAST(c_custkey AS VARCHAR) AS c_custkey,
           CASE WHEN LENGTH(c_name) > 12 THEN LEFT(c_name, 9) || '...' ELSE c_name END AS c_name,
           COALESCE(CASE WHEN c_acctbal >= 9900 THEN NULL ELSE c_mktsegment END, 'null') AS segment,
           '[' || c_nationkey || ', null]' AS codes,
           '[' || REGEXP_REPLACE(HEX(LEFT(c_mktsegment, 3)), '(..)(..)(..)', '\\1 \\2 \\3') || ']' AS bytes,
           '&lt;' || c_nationkey || '&gt;' AS tag
    FROM customer ORDER BY c_acctbal DESC, customer.c_custkey LIMIT 100""", name="render_rows")
def render_top_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    top = table(spark, sf_dir, "customer").orderBy(F.desc("c_acctbal"), "c_custkey")
    shown = top.selectExpr(
        "c_custkey",
        "c_name",
        "CASE WHEN c_acctbal >= 9900 THEN NULL ELSE c_mktsegment END AS segment",
        "array(c_nationkey, NULL) AS codes",
        "cast(left(c_mktsegment, 3) AS binary) AS bytes",
        "concat('<', c_nationkey, '>') AS tag",
    )
    return render_rows(shown, limit=100, truncate=12)


@query("SELECT EPOCH_US(ts) // 1000 AS timestamp, event_id, user_id, event_type, value FROM events", name="log_events")
def log_event_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    shaped = log_events(table(spark, sf_dir, "events"), "ts")
    fields = F.from_json("message", "event_id bigint, user_id bigint, event_type string, value double")
    return shaped.select("timestamp", fields.alias("m")).select("timestamp", "m.*")


@query("""
    SELECT EPOCH_US(ts) // 1000 AS timestamp, event_id, user_id, event_type, value FROM events
    WHERE event_type <> 'view'""")
def log_events_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As a destination of a job: rows become log events, with their time from a text column and its pattern."""
    text = """
        SELECT event_id, user_id, event_type, value, date_format(ts, "dd.MM.yyyy HH:mm:ss.SSS") AS at FROM e
        WHERE event_type != 'view'"""
    shape = {"logevents": True, "timestamp_column": "at", "timestamp_format": "dd.MM.yyyy HH:mm:ss.SSS"}
    path = moved(spark, {"source": source(sf_dir, "events", "e"), "sql": {"query": text}}, "json", **shape)
    shaped = spark.read.schema("timestamp bigint, message string").json(path)
    fields = F.from_json("message", "event_id bigint, user_id bigint, event_type string, value double")
    return shaped.select("timestamp", fields.alias("m")).select("timestamp", "m.*")
