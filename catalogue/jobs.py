"""Whole jobs: pass-through, SQL from text and file, templates, commands, counts, parallel runs, moves by watermark."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalogue.registry import files, moved, query, source, stage, table
from rowferry import move, run_job, run_jobs, scratch_dir, transform
from rowferry.operators import WatermarkState


@query("SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def job_passthrough(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(moved(spark, {"source": source(sf_dir, "supplier")}))


PER_REGION = """
    SELECT r.r_name, COUNT(*) AS customers, MAX(c.c_acctbal) AS richest
    FROM c JOIN n ON c.c_nationkey = n.n_nationkey JOIN r ON n.n_regionkey = r.r_regionkey GROUP BY r.r_name"""
PER_REGION_ORACLE = f"""
    WITH c AS (SELECT * FROM customer), n AS (SELECT * FROM nation), r AS (SELECT * FROM region) {PER_REGION}"""


def _region_sources(sf_dir: str) -> list[dict[str, object]]:
    return [source(sf_dir, "customer", "c"), source(sf_dir, "nation", "n"), source(sf_dir, "region", "r")]


@query(PER_REGION_ORACLE)
def job_multi_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.orc(moved(spark, {"sources": _region_sources(sf_dir), "sql": {"query": PER_REGION}}, "orc"))


@query(PER_REGION_ORACLE)
def job_sql_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = stage(spark, spark.range(0, 1, 1, 1).select(F.lit(PER_REGION.replace("\n", " ")).alias("value")), "text")
    return transform(spark, {"sources": _region_sources(sf_dir), "sql": {"inputfile": {"path": path}}})


@query("""
    SELECT o_orderkey, o_totalprice FROM orders
    WHERE o_orderdate = (SELECT MAX(o_orderdate) FROM orders)
       OR o_totalprice = (SELECT MIN(o_totalprice) FROM orders)""")
def inline_expr(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = f"parquet.`{sf_dir}/orders.parquet`"
    text = (
        "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderdate = "
        f"timestamp_ntz'inlineexpr{{{{SELECT max(o_orderdate) FROM {orders}}}}}' "
        f"OR o_totalprice = inlineexpr{{{{SELECT min(o_totalprice) FROM {orders}}}}}D"
    )
    return transform(spark, {"source": source(sf_dir, "orders"), "sql": {"query": text}})


@query("""
    SELECT o_orderstatus AS label, COUNT(*) AS n FROM orders GROUP BY o_orderstatus
    UNION ALL SELECT 'all', COUNT(*) FROM orders""")
def hooks_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    token = uuid.uuid4().hex[:12]
    read, written = f"hooks_in_{token}", f"hooks_out_{token}"
    move(
        spark,
        {
            "source": {
                "platform": "hive",
                "alias": "o",
                "query": f"SELECT * FROM {read}",
                "pre_migrate_command": f"CREATE TABLE {read} USING parquet OPTIONS (path '{sf_dir}/orders.parquet')",
                # runs after the write and before the destination's own commands
                "post_migrate_command": f"INSERT INTO {written} SELECT 'all', sum(n) FROM {written}",
            },
            "sql": {"query": "SELECT o_orderstatus, count(*) FROM o GROUP BY o_orderstatus"},
            "destination": {
                "platform": "hive",
                "table": written,
                "pre_migrate_commands": [
                    {
                        "query": f"CREATE TABLE {written} (label STRING, n BIGINT) USING parquet "
                        f"LOCATION '{scratch_dir(spark, 'hooks')}'"
                    }
                ],
                "post_migrate_commands": [{"query": f"DROP TABLE {read}"}],
            },
        },
    )
    return spark.table(written)


@query("SELECT COUNT(*) AS written FROM lineitem WHERE l_returnflag <> 'N'")
def observed_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    job = {
        "source": source(sf_dir, "lineitem", "l"),
        "sql": {"query": "SELECT * FROM l WHERE l_returnflag <> 'N'"},
        "destination": files(scratch_dir(spark, "counted"), "parquet"),
    }
    result = run_job(spark, job, precise_counts=True)
    if result.error:
        raise RuntimeError(result.error)
    return spark.range(1).select(F.lit(result.count).cast("bigint").alias("written"))


@query("""
    SELECT 'customer' AS name, COUNT(*) AS n FROM customer UNION ALL SELECT 'orders', COUNT(*) FROM orders
    UNION ALL SELECT 'part', COUNT(*) FROM part UNION ALL SELECT 'supplier', COUNT(*) FROM supplier""")
def jobs_parallel(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "parallel")
    jobs = [
        {"source": source(sf_dir, name), "destination": files(f"{path}/name={name}", "parquet")}
        for name in ("customer", "orders", "part", "supplier")
    ]
    run_jobs(spark, {"migrations": jobs, "parallelmigrations": True})
    return spark.read.parquet(path).groupBy("name").agg(F.count("*").alias("n"))


@query("""
    SELECT event_id, user_id, value, CASE WHEN ts <= TIMESTAMP '2024-01-11 00:00:00' THEN 0 ELSE 1 END AS move FROM events
    WHERE ts > TIMESTAMP '2024-01-01 00:00:00' AND ts <= TIMESTAMP '2024-01-21 12:00:00'""")
def delta_watermark(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two moves in a row; the second one takes up where the first one ended."""
    state = WatermarkState(spark, scratch_dir(spark, "state"), "events", datetime(2024, 1, 1))
    events = table(spark, sf_dir, "events")
    target = scratch_dir(spark, "delta")
    for number, until in enumerate([datetime(2024, 1, 11), datetime(2024, 1, 21, 12)]):
        window = state.open(until)
        state.select(events, "ts", window).write.parquet(f"{target}/move={number}")
        state.close(window)
    return spark.read.parquet(target).select("event_id", "user_id", "value", "move")
