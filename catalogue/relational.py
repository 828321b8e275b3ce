"""Projections, filters, joins, aggregates, windows and set operations as jobs express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalogue.registry import files, query, source, stage, table
from rowferry import transform
from rowferry.operators import (
    affected_rows,
    collect_distinct,
    join_prefixed,
    latest_per_key,
    missing_rows,
    nest,
)


def run_sql(spark: SparkSession, sf_dir: str, text: str, *names: str) -> DataFrame:
    """One SQL text over driver tables, as a job without a destination."""
    return transform(spark, {"sources": [source(sf_dir, n) for n in names], "sql": {"query": text}})


def same_sql(name: str, text: str, *tables: str) -> None:
    """Register a query whose SQL text both engines understand as it stands."""
    query(text, name)(lambda spark, sf_dir: run_sql(spark, sf_dir, text, *tables))


same_sql("project_rename", "SELECT o_orderkey AS id, o_totalprice AS price FROM orders", "orders")
same_sql(
    "filter_pred",
    "SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal < 0 AND c_mktsegment = 'BUILDING'",
    "customer",
)
same_sql(
    "case_when",
    "SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'finished' WHEN 'O' THEN 'open' ELSE 'other' END AS state "
    "FROM orders",
    "orders",
)
same_sql(
    "order_limit",
    "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10",
    "orders",
)
same_sql(
    "join_inner",
    "SELECT o_orderkey, c_name, o_totalprice FROM orders JOIN customer ON o_custkey = c_custkey",
    "orders",
    "customer",
)
THREE_WAY = (
    "SELECT X.c_custkey, X.c_name, Y.o_orderkey, Y.o_totalprice, Z.n_name "
    "FROM customer X JOIN orders Y ON X.c_custkey = Y.o_custkey JOIN nation Z ON X.c_nationkey = Z.n_nationkey"
)
same_sql("join_three_way", THREE_WAY, "customer", "orders", "nation")
same_sql(
    "join_left",
    "SELECT event_id, event_type, c_name FROM events LEFT JOIN customer ON user_id = c_custkey AND c_acctbal > 5000",
    "events",
    "customer",
)
same_sql(
    "derived_tables",
    "SELECT n_name, busiest FROM nation JOIN (SELECT c_nationkey, MAX(orders) AS busiest FROM "
    "(SELECT c_custkey, c_nationkey, COUNT(*) AS orders FROM (SELECT * FROM orders WHERE o_orderstatus = 'F') f "
    "JOIN customer ON c_custkey = o_custkey GROUP BY c_custkey, c_nationkey) per_customer "
    "GROUP BY c_nationkey) per_nation ON n_nationkey = c_nationkey",
    "nation",
    "customer",
    "orders",
)
same_sql("count_rows", "SELECT COUNT(*) AS n FROM lineitem", "lineitem")
same_sql("distinct_keys", "SELECT DISTINCT o_custkey FROM orders", "orders")
same_sql(
    "union_all",
    "SELECT c_custkey AS id, c_name AS name FROM customer UNION ALL SELECT s_suppkey, s_name FROM supplier",
    "customer",
    "supplier",
)
same_sql(
    "union_distinct",
    "SELECT c_nationkey AS nation, CAST(c_custkey AS BIGINT) AS id FROM customer UNION "
    "SELECT s_nationkey, s_suppkey FROM supplier UNION SELECT c_nationkey, c_custkey FROM customer",
    "customer",
    "supplier",
)


@query("""
    SELECT event_id, TRY_CAST(event_type AS INTEGER) AS as_int, CAST(TRUNC(value) AS INTEGER) AS whole FROM events""")
def cast_lenient(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = "SELECT event_id, CAST(event_type AS INT) AS as_int, CAST(value AS INT) AS whole FROM events"
    return run_sql(spark, sf_dir, text, "events")


@query("SELECT o_orderkey, o_orderstatus AS status, o_totalprice AS price FROM orders")
def nested_access(spark: SparkSession, sf_dir: str) -> DataFrame:
    nested = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS key", "struct(o_orderstatus AS Status, o_totalprice AS Price) AS value"
    )
    path = stage(spark, nested, "parquet")
    text = "SELECT key AS o_orderkey, value.Status AS status, value.Price AS price FROM kf"
    return transform(spark, {"source": files(path, "parquet", alias="kf"), "sql": {"query": text}})


@query("""
    SELECT o_orderkey, '{"o_orderstatus":"' || o_orderstatus || '","o_custkey":' || o_custkey || '}' AS pair,
           '{"id2":' || o_orderkey || '}' AS renamed, o_custkey AS star_key
    FROM orders""")
def struct_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = (
        "SELECT o_orderkey, to_json(struct(o_orderstatus, o_custkey)) AS pair, "
        "to_json(struct(o_orderkey AS id2)) AS renamed, struct(o.*).o_custkey AS star_key FROM orders o"
    )
    return run_sql(spark, sf_dir, text, "orders")


@query("""
    SELECT c.c_custkey AS X_id, c.c_name AS X_name, o.n AS Y_n, s.s_name AS Z_name
    FROM customer c
    JOIN (SELECT o_custkey, COUNT(*) AS n FROM orders GROUP BY o_custkey) o ON c.c_custkey = o.o_custkey
    JOIN supplier s ON c.c_custkey = s.s_suppkey""", name="join_prefixed")
def join_prefixed_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = table(spark, sf_dir, "customer").selectExpr("c_custkey id", "c_name name")
    y = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("id")).agg(F.count("*").alias("n"))
    z = table(spark, sf_dir, "supplier").selectExpr("s_suppkey id", "s_name name")
    return join_prefixed({"X": x, "Y": y, "Z": z}, "id").select("X_id", "X_name", "Y_n", "Z_name")


@query("""
    SELECT o_orderkey, o_totalprice FROM orders
    WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)""")
def delta_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = table(spark, sf_dir, "lineitem").withColumnRenamed("l_orderkey", "o_orderkey")
    return missing_rows(table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice"), moved, "o_orderkey")


@query("""
    SELECT o_orderkey, o_totalprice FROM orders
    WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'R')""")
def semi_affected(spark: SparkSession, sf_dir: str) -> DataFrame:
    returned = table(spark, sf_dir, "lineitem").where("l_returnflag = 'R'").selectExpr("l_orderkey o_orderkey")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return affected_rows(orders, returned, "o_orderkey")


@query("""
    SELECT n_name, COALESCE((SELECT STRING_AGG(DISTINCT c_mktsegment, ',' ORDER BY c_mktsegment) FROM customer
                             WHERE c_nationkey = n_nationkey), '') AS segments
    FROM nation""")
def correlated_collect(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = (
        "SELECT n_name, array_join(sort_array((SELECT collect_set(c_mktsegment) FROM customer "
        "WHERE c_nationkey = n_nationkey)), ',') AS segments FROM nation"
    )
    return run_sql(spark, sf_dir, text, "nation", "customer")


@query("""
    SELECT o_custkey, STRING_AGG(DISTINCT o_orderpriority, ',' ORDER BY o_orderpriority) AS priorities
    FROM orders GROUP BY o_custkey""")
def collect_set_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    sets = collect_distinct(table(spark, sf_dir, "orders"), ["o_custkey"], "o_orderpriority")
    return sets.select("o_custkey", F.concat_ws(",", "o_orderpriority").alias("priorities"))


@query("""
    WITH bought AS (
        SELECT DISTINCT c_nationkey, c_mktsegment, o_orderpriority FROM customer JOIN orders ON c_custkey = o_custkey),
    per_segment AS (
        SELECT c_nationkey, c_mktsegment, STRING_AGG('"' || o_orderpriority || '"', ',' ORDER BY o_orderpriority) AS y
        FROM bought GROUP BY ALL),
    segments AS (
        SELECT DISTINCT c_nationkey, c_mktsegment, COALESCE(y, '') AS y
        FROM customer LEFT JOIN per_segment USING (c_nationkey, c_mktsegment))
    SELECT n_name, '[' || COALESCE((
        SELECT STRING_AGG('{"UnitID":"' || c_mktsegment || '","Y":[' || y || ']}', ',' ORDER BY c_mktsegment)
        FROM segments WHERE c_nationkey = n_nationkey), '') || ']' AS document
    FROM nation""")
def nested_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").withColumn("unit", F.concat_ws("|", "c_nationkey", "c_mktsegment"))
    bought = table(spark, sf_dir, "orders").join(customers, F.col("o_custkey") == F.col("c_custkey"))
    units = customers.select("c_nationkey", "c_mktsegment", "unit").distinct()
    units = nest(units, bought, ("unit", "unit"), "o_orderpriority", "priorities")
    fields = {"UnitID": "c_mktsegment", "Y": "priorities"}
    documents = nest(table(spark, sf_dir, "nation"), units, ("n_nationkey", "c_nationkey"), fields, "unitInfo")
    return documents.select("n_name", F.to_json("unitInfo").alias("document"))


@query("""
    SELECT user_id, event_id, event_type, value FROM (
        SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)
    WHERE rn = 1""", name="latest_per_key")
def latest_event_per_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "value", "ts")
    return latest_per_key(events, "user_id", [F.desc("ts"), F.desc("event_id")]).drop("ts")
