"""Sources: file formats, schemas, partition discovery and the catalog."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalogue.registry import dated, files, query, stage, table
from rowferry import scratch_dir
from rowferry.sources import read_source

HEADER = {"header": "true"}


@query("""
    SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey,
           CAST(c_acctbal AS VARCHAR) AS c_acctbal, c_mktsegment
    FROM customer""")
def src_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = stage(spark, table(spark, sf_dir, "customer"), "csv", **HEADER)
    return read_source(spark, files(path, "csv"))


@query("""
    SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, o_orderstatus,
           CAST(o_totalprice AS VARCHAR) AS o_totalprice, STRFTIME(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate,
           o_orderpriority
    FROM orders""")
def src_tsv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = stage(spark, table(spark, sf_dir, "orders"), "csv", sep="\t", **HEADER)
    return dated(read_source(spark, files(path, "csv", delimiter="\t")), "o_orderdate")


@query("SELECT c_name || '|' || c_mktsegment AS value FROM customer")
def src_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "customer").select(F.concat_ws("|", "c_name", "c_mktsegment").alias("value"))
    return read_source(spark, files(stage(spark, lines, "text"), "text"))


@query("""
    SELECT o_orderkey, o_custkey, o_orderstatus AS status, o_totalprice AS price, o_orderpriority AS priority,
           STRFTIME(o_orderdate, '%Y-%m-%d %H:%M:%S') AS placed
    FROM orders""")
def src_json_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        "o_custkey",
        F.struct(
            F.col("o_orderstatus").alias("status"),
            F.struct(
                F.col("o_totalprice").alias("price"),
                F.col("o_orderpriority").alias("priority"),
                F.col("o_orderdate").alias("placed"),
            ).alias("terms"),
        ).alias("detail"),
    )
    df = read_source(spark, files(stage(spark, orders, "json"), "json"))
    return dated(df.select("o_orderkey", "o_custkey", "detail.status", "detail.terms.*"), "placed")


@query("""
    SELECT 'customer' AS kind, c_custkey AS id, c_name AS name, c_mktsegment AS segment, NULL::DOUBLE AS balance
    FROM customer
    UNION ALL
    SELECT 'supplier', s_suppkey, s_name, NULL, s_acctbal FROM supplier""")
def src_parquet_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").selectExpr("c_custkey id", "c_name name", "c_mktsegment segment")
    suppliers = table(spark, sf_dir, "supplier").selectExpr("s_suppkey id", "s_name name", "s_acctbal balance")
    path = scratch_dir(spark, "merge")
    customers.write.parquet(f"{path}/kind=customer")
    suppliers.write.parquet(f"{path}/kind=supplier")
    df = read_source(spark, files(path, "parquet", mergeschema="true"))
    return df.select("kind", "id", "name", "segment", "balance")


@query("SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part")
def src_schema_ddl(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = stage(spark, table(spark, sf_dir, "part"), "csv", **HEADER)
    ddl = "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"
    return read_source(spark, files(path, "csv", schema=ddl))


@query("SELECT * REPLACE (STRFTIME(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate) FROM orders")
def src_orc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = stage(spark, table(spark, sf_dir, "orders"), "orc")
    return dated(read_source(spark, files(path, "orc")), "o_orderdate")


@query("""
    SELECT o_orderstatus, COUNT(*) AS n, CAST(SUM(CAST(o_totalprice AS DECIMAL(18, 2))) AS DOUBLE) AS total
    FROM orders GROUP BY o_orderstatus""")
def src_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "by-status")
    table(spark, sf_dir, "orders").write.partitionBy("o_orderstatus").parquet(path)
    df = read_source(spark, files(path, "parquet"))
    total = F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double")
    return df.groupBy("o_orderstatus").agg(F.count("*").alias("n"), total.alias("total"))


@query("SELECT p_brand, COUNT(*) AS n, MAX(p_retailprice) AS top FROM part WHERE p_size > 10 GROUP BY p_brand")
def src_catalog_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = f"part_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE TABLE {name} USING parquet OPTIONS (path '{sf_dir}/part.parquet')")
    text = f"SELECT p_brand, COUNT(*) AS n, MAX(p_retailprice) AS top FROM {name} WHERE p_size > 10 GROUP BY p_brand"
    endpoint = {"platform": "hive", "query": text, "properties": {"spark.sql.caseSensitive": "false"}}
    return read_source(spark, endpoint)
