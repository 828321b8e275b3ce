"""Verification of moves, comparison by key, run history."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalogue.registry import moved, query, source, table
from rowferry.operators import compare_by_key, latest_status, time_alerts, verify
from rowferry.session import Files

# bytes of the given line items that make up one file of a copy
COPY_BYTES = 64 * 1024 * 1024


@query("""
    SELECT COUNT(*) AS source_count, COUNT(*) AS destination_count, COUNT(*) AS union_count, 'succeeded' AS status
    FROM orders""")
def verify_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    copied = spark.read.parquet(moved(spark, {"source": source(sf_dir, "orders")}))
    return verify(table(spark, sf_dir, "orders"), copied).drop("difference")


@query("""
    SELECT COUNT(*) AS source_count, COUNT(*) AS destination_count,
           COUNT(*) + COUNT(*) FILTER (WHERE o_orderstatus = 'P') AS union_count, 'failed' AS status
    FROM orders""")
def verify_mismatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    price = F.when(F.col("o_orderstatus") == "P", F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))
    return verify(orders, orders.withColumn("o_totalprice", price)).drop("difference")


@query("""
    SELECT CAST(COUNT(*) AS BIGINT) AS source_count, CAST(COUNT(*) AS BIGINT) AS destination_count,
           CAST(COUNT(DISTINCT (l_returnflag, l_linestatus, l_quantity)) AS BIGINT) AS union_count,
           'succeeded' AS status
    FROM lineitem""")
def verify_multiset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that repeat very often, written and read back."""
    text = "SELECT l_returnflag, l_linestatus, l_quantity FROM l"
    job = {"source": source(sf_dir, "lineitem", "l"), "sql": {"query": text}}
    copied = spark.read.parquet(moved(spark, job, groupbyfields="l_linestatus"))
    given = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_linestatus", "l_quantity")
    return verify(given, copied, "multiset").drop("difference")


@query("""
    WITH d AS (
        SELECT c_custkey, c_name, CASE WHEN c_acctbal < 0 THEN 0 ELSE c_acctbal END AS c_acctbal FROM customer
        WHERE c_mktsegment <> 'BUILDING' UNION ALL SELECT -1 - s_suppkey, s_name, s_acctbal FROM supplier)
    SELECT COALESCE(c.c_custkey, d.c_custkey) AS c_custkey,
           CASE WHEN d.c_custkey IS NULL THEN 'missing in destination' WHEN c.c_custkey IS NULL THEN 'missing in source'
                ELSE 'different' END AS finding,
           CASE WHEN c.c_custkey = d.c_custkey THEN 'c_acctbal' END AS "column",
           CASE WHEN c.c_custkey = d.c_custkey THEN CAST(c.c_acctbal AS VARCHAR) END AS source_value,
           CASE WHEN c.c_custkey = d.c_custkey THEN CAST(d.c_acctbal AS VARCHAR) END AS destination_value
    FROM customer c FULL JOIN d ON c.c_custkey = d.c_custkey
    WHERE c.c_custkey IS NULL OR d.c_custkey IS NULL OR c.c_acctbal <> d.c_acctbal""", name="compare_by_key")
def compared_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")
    kept = given.where("c_mktsegment <> 'BUILDING'").selectExpr(
        "c_custkey", "c_name", "if(c_acctbal < 0, 0D, c_acctbal) AS c_acctbal"
    )
    added = table(spark, sf_dir, "supplier").selectExpr("-1 - s_suppkey", "s_name", "s_acctbal")
    return compare_by_key(given, kept.union(added), "c_custkey")


@query("""
    SELECT COUNT(*) AS source_count, COUNT(*) AS destination_count, 'succeeded' AS status FROM lineitem
    UNION ALL SELECT COUNT(*), COUNT(*), 'failed' FROM lineitem""")
def verify_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Without an exchange of rows: line items in another order, and with two prices that changed places.

    The copy has three files and one more for every COPY_BYTES of the table, so that a task's share stays the same.
    """
    items = table(spark, sf_dir, "lineitem")
    count = 3 + Files(spark).size(f"{sf_dir}/lineitem.parquet") // COPY_BYTES
    copied = spark.read.parquet(moved(spark, {"source": source(sf_dir, "lineitem")}, coalescefilecount=count))
    swapped = F.when(F.col("l_quantity") == 1, F.col("l_tax")).otherwise(F.col("l_discount"))
    back = F.when(F.col("l_quantity") == 1, F.col("l_discount")).otherwise(F.col("l_tax"))
    other = items.withColumns({"l_discount": swapped, "l_tax": back})
    return verify(items, copied, "sums").union(verify(items, other, "sums"))


@query("""
    SELECT o_orderkey, CASE WHEN o_orderkey % 89 = 0 THEN 'missing in destination' ELSE 'different' END AS finding,
           CASE WHEN o_orderkey % 89 > 0 THEN 'o_orderstatus' END AS "column",
           CASE WHEN o_orderkey % 89 > 0 THEN o_orderstatus END AS source_value,
           CASE WHEN o_orderkey % 89 > 0 THEN 'X' END AS destination_value
    FROM orders WHERE o_orderkey % 89 = 0 OR o_orderkey % 97 = 0""")
def compare_by_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As for large tables: only key ranges whose digests differ are joined."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    status = F.when(F.col("o_orderkey") % 97 == 0, "X").otherwise(F.col("o_orderstatus"))
    return compare_by_key(orders, orders.where("o_orderkey % 89 != 0").withColumn("o_orderstatus", status), "o_orderkey")


# A run history in which every user is a job and every event one of its runs.
STATUS = "CASE event_type WHEN 'view' THEN 'Started' WHEN 'error' THEN 'Failed' ELSE 'Completed' END"


def _history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(
        "cast(user_id AS string) AS MigrationId",
        "cast(event_id AS string) AS JobId",
        "ts AS StartTime",
        "CASE WHEN event_type <> 'view' THEN ts END AS EndTime",
        "cast(floor(value) AS bigint) AS ElapsedTimeInMinutes",
        f"{STATUS} AS Status",
    )


@query(f"""
    SELECT MigrationId, JobId, Status FROM (
        SELECT CAST(user_id AS VARCHAR) AS MigrationId, CAST(event_id AS VARCHAR) AS JobId, {STATUS} AS Status,
               ROW_NUMBER() OVER (
                   PARTITION BY user_id ORDER BY ts DESC, event_type = 'view', CAST(event_id AS VARCHAR) DESC) AS rn
        FROM events)
    WHERE rn = 1""")
def history_latest_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_status(_history(spark, sf_dir)).select("MigrationId", "JobId", "Status")


@query(f"""
    SELECT CAST(user_id AS VARCHAR) AS MigrationId, CAST(event_id AS VARCHAR) AS JobId,
           CAST(FLOOR(value) AS BIGINT) AS elapsed,
           CASE WHEN FLOOR(value) < c_nationkey THEN 'shorter' ELSE 'longer' END AS alert
    FROM events JOIN customer ON user_id = c_custkey
    WHERE event_type <> 'view' AND (FLOOR(value) < c_nationkey OR FLOOR(value) > c_nationkey + 40)""")
def history_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    limits = table(spark, sf_dir, "customer").selectExpr(
        "cast(c_custkey AS string) AS MigrationId",
        "c_nationkey AS minexecutiontime",
        "c_nationkey + 40 AS maxexecutiontime",
    )
    alerts = time_alerts(_history(spark, sf_dir), limits)
    return alerts.selectExpr("MigrationId", "JobId", "ElapsedTimeInMinutes AS elapsed", "alert")
