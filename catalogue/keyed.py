"""Keyed writes. The stored rows are the customers; changes come from all orders, new keys from the suppliers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalogue.registry import files, query, source, table
from rowferry import move, scratch_dir
from rowferry.operators import delete_rows, keyed_write, write_documents
from rowferry.operators.swap import seal
from rowferry.session import Files

# columns of a change: the key, a new balance, and a segment that is null for some keys
CHANGED = """
    SELECT o_custkey AS c_custkey, MAX(o_totalprice) AS c_acctbal,
           CASE WHEN COUNT(*) > 15 THEN 'LARGE' END AS c_mktsegment
    FROM orders GROUP BY o_custkey"""
ADDED = """
    SELECT -1 - s_suppkey AS c_custkey, s_acctbal AS c_acctbal, CAST(NULL AS VARCHAR) AS c_mktsegment FROM supplier"""
CHANGES = f"{CHANGED} UNION ALL {ADDED}"


def stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer")


def changed(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.max("o_totalprice").alias("c_acctbal"),
        F.when(F.count("*") > 15, "LARGE").alias("c_mktsegment"),
    )


def changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    added = table(spark, sf_dir, "supplier").selectExpr("-1 - s_suppkey c_custkey", "s_acctbal c_acctbal")
    return changed(spark, sf_dir).unionByName(added, allowMissingColumns=True)


@query(f"""
    WITH new AS ({CHANGES})
    SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer
    WHERE c_custkey NOT IN (SELECT c_custkey FROM new)
    UNION ALL SELECT c_custkey, NULL, NULL, c_acctbal, c_mktsegment FROM new""")
def keyed_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keyed_write(stored(spark, sf_dir), changes(spark, sf_dir), "c_custkey", "index")


@query("""
    SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer
    UNION ALL SELECT -1 - s_suppkey, s_name, s_nationkey, s_acctbal, NULL FROM supplier""")
def keyed_create(spark: SparkSession, sf_dir: str) -> DataFrame:
    added = table(spark, sf_dir, "supplier").selectExpr(
        "-1 - s_suppkey c_custkey", "s_name c_name", "s_nationkey c_nationkey", "s_acctbal c_acctbal"
    )
    return keyed_write(stored(spark, sf_dir), added, "c_custkey", "create")


@query(f"""
    WITH new AS ({CHANGED})
    SELECT c_custkey, c_name, c_nationkey, COALESCE(n.c_acctbal, o.c_acctbal) AS c_acctbal,
           COALESCE(n.c_mktsegment, o.c_mktsegment) AS c_mktsegment
    FROM customer o LEFT JOIN new n USING (c_custkey)""")
def keyed_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keyed_write(stored(spark, sf_dir), changed(spark, sf_dir), "c_custkey", "update")


UPSERTED = f"""
    WITH new AS ({CHANGES})
    SELECT c_custkey, c_name, c_nationkey, COALESCE(n.c_acctbal, o.c_acctbal) AS c_acctbal,
           COALESCE(n.c_mktsegment, o.c_mktsegment) AS c_mktsegment
    FROM customer o FULL JOIN new n USING (c_custkey)"""


@query(UPSERTED)
def keyed_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As a job: the destination dataset is rewritten with the changes merged in."""
    path = scratch_dir(spark, "keyed")
    move(spark, {"source": source(sf_dir, "customer"), "destination": files(path, "parquet")})
    job = {
        "sources": [source(sf_dir, "orders"), source(sf_dir, "supplier")],
        "sql": {"query": CHANGES.replace("VARCHAR", "STRING")},
        "destination": files(path, "parquet", savemode="upsert", mappingid="c_custkey"),
    }
    move(spark, job)
    return spark.read.parquet(path)


@query(UPSERTED)
def upsert_ignore_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keyed_write(stored(spark, sf_dir), changes(spark, sf_dir), "c_custkey", "upsert", ignore_nulls=True)


@query(f"""
    WITH new AS ({CHANGES})
    SELECT c_custkey, c_name, c_nationkey,
           CASE WHEN n.c_custkey IS NULL THEN o.c_acctbal ELSE n.c_acctbal END AS c_acctbal,
           CASE WHEN n.c_custkey IS NULL THEN o.c_mktsegment ELSE n.c_mktsegment END AS c_mktsegment
    FROM customer o FULL JOIN new n USING (c_custkey)""")
def upsert_with_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keyed_write(stored(spark, sf_dir), changes(spark, sf_dir), "c_custkey", "upsert", ignore_nulls=False)


PRICED = """
    SELECT o_orderkey, o_orderkey % 40 AS slot,
           COALESCE(n.price, o_totalprice) AS price, o_orderkey % 40 NOT IN (SELECT slot FROM new) AS kept
    FROM orders o LEFT JOIN new n USING (o_orderkey)
    UNION ALL SELECT o_orderkey, slot, price, FALSE FROM new WHERE o_orderkey < 0"""


@query(f"""
    WITH new AS (
        SELECT o_orderkey, o_orderkey % 40 AS slot, -o_totalprice AS price FROM orders
        WHERE o_totalprice < 20000 AND o_orderkey % 40 < 5
        UNION ALL SELECT -40 * s_suppkey, 0, s_acctbal FROM supplier) {PRICED}""")
def keyed_upsert_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As a job: a few orders change, and only files that hold one of them are written anew; `kept` tells the others."""
    path = scratch_dir(spark, "keyed")
    text = "SELECT o_orderkey, o_orderkey % 40 AS slot, o_totalprice AS price FROM o"
    job = {"source": source(sf_dir, "orders", "o"), "sql": {"query": text}}
    move(spark, {**job, "destination": files(path, "parquet", groupbyfields="slot")})
    before = spark.read.parquet(path).select(F.col("_metadata.file_name").alias("file")).distinct().collect()
    text = """
        SELECT o_orderkey, o_orderkey % 40 AS slot, -o_totalprice AS price FROM o
        WHERE o_totalprice < 20000 AND o_orderkey % 40 < 5
        UNION ALL SELECT -40 * s_suppkey, 0, s_acctbal FROM s"""
    job = {"sources": [source(sf_dir, "orders", "o"), source(sf_dir, "supplier", "s")], "sql": {"query": text}}
    move(spark, {**job, "destination": files(path, "parquet", savemode="upsert", mappingid="o_orderkey")})
    kept = F.col("_metadata.file_name").isin([r["file"] for r in before]).alias("kept")
    return spark.read.parquet(path).select("o_orderkey", F.col("slot").cast("bigint"), "price", kept)


@query("""
    SELECT c_custkey, -c_acctbal AS c_acctbal,
           CASE WHEN c_custkey IN (SELECT s_suppkey FROM supplier) THEN 'supplier' ELSE c_name END AS c_name
    FROM customer""")
def keyed_after_lost_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A rewrite whose driver was lost once its new files were sealed: the next keyed write finishes it first."""
    path = scratch_dir(spark, "keyed")
    table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal", "c_name").write.parquet(path)
    negated = spark.read.parquet(path).withColumn("c_acctbal", -F.col("c_acctbal"))
    old = [name for name, _ in Files(spark).walk(path)]
    seal(spark, path, negated.write.parquet, lambda _: old)
    text = "SELECT s_suppkey AS c_custkey, 'supplier' AS c_name FROM s JOIN c ON c_custkey = s_suppkey"
    job = {"sources": [source(sf_dir, "supplier", "s"), source(sf_dir, "customer", "c")], "sql": {"query": text}}
    move(spark, {**job, "destination": files(path, "parquet", savemode="update", mappingid="c_custkey")})
    return spark.read.parquet(path)


ITEMS = """
    SELECT l_orderkey AS o_orderkey, SUM(l_quantity) AS o_totalprice, MIN(l_returnflag) AS o_orderstatus
    FROM lineitem WHERE l_orderkey % 3 > 0 GROUP BY l_orderkey
    UNION ALL
    SELECT -1 - l_orderkey, SUM(l_quantity), MAX(l_linestatus) FROM lineitem GROUP BY l_orderkey"""


@query(f"""
    WITH new AS ({ITEMS})
    SELECT o_orderkey, o.o_custkey, COALESCE(n.o_orderstatus, o.o_orderstatus) AS status,
           ROUND(COALESCE(n.o_totalprice, o.o_totalprice), 2) AS price
    FROM orders o FULL JOIN new n USING (o_orderkey)""")
def keyed_upsert_large(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As a job: the changes are all line items, old orders and as many new ones."""
    path = scratch_dir(spark, "keyed")
    move(spark, {"source": source(sf_dir, "orders"), "destination": files(path, "parquet")})
    job = {
        "source": source(sf_dir, "lineitem"),
        "sql": {"query": ITEMS},
        "destination": files(path, "parquet", savemode="upsert", mappingid="o_orderkey"),
    }
    move(spark, job)
    price = F.round("o_totalprice", 2).alias("price")
    return spark.read.parquet(path).select("o_orderkey", "o_custkey", F.col("o_orderstatus").alias("status"), price)


@query("""
    SELECT o_orderkey, o_totalprice FROM orders
    WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R' AND l_quantity >= 40)""")
def delete_by_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    selection = table(spark, sf_dir, "lineitem").where("l_returnflag = 'R' AND l_quantity >= 40")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return delete_rows(orders, selection.withColumnRenamed("l_orderkey", "o_orderkey"), "o_orderkey")


def _documents(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    kept = table(spark, sf_dir, "customer").selectExpr("c_custkey _id", "c_name name", "c_acctbal balance")
    orders = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("_id"))
    given = orders.agg(F.count("*").alias("orders"))
    return kept, given


DOCUMENTS = """
    SELECT o_custkey AS _id, COUNT(*) AS orders FROM orders GROUP BY o_custkey"""


@query(f"""
    WITH new AS ({DOCUMENTS})
    SELECT c_custkey AS _id, CASE WHEN n._id IS NULL THEN c_name END AS name,
           CASE WHEN n._id IS NULL THEN c_acctbal END AS balance, orders
    FROM customer LEFT JOIN new n ON c_custkey = n._id""")
def doc_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    return write_documents(*_documents(spark, sf_dir), replacedocuments=True)


@query(f"""
    WITH new AS ({DOCUMENTS})
    SELECT c_custkey AS _id, c_name AS name, c_acctbal AS balance, orders
    FROM customer LEFT JOIN new n ON c_custkey = n._id""")
def doc_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return write_documents(*_documents(spark, sf_dir), replacedocuments=False)
